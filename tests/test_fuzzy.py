"""Near mentions by joins against the search text by text."""

import difflib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tempolith.operators import align, fuzzy
from tempolith.plans.catalogue import ORACLE, QUERIES
from tempolith.sinks.files import keeper

WORDS = "the patient started ended therapy with carboplatin paclitaxel on in march and after cycle was given §é𝄞 no yes".split()


def edited(rng, text, share):
    out = list(text)
    for i in range(len(out)):
        x = rng.random()
        if x < share:
            out[i] = rng.choice(["", "#", out[i] + "+", "a", "𝄞"])
    return "".join(out)


def cases(rng, n):
    for i in range(n):
        text = " ".join(rng.choice(WORDS) for _ in range(rng.choice([0, 5, 60, 150])))
        at, size = rng.randrange(max(1, len(text))), rng.choice([3, 9, 30, 120, 200, 400])
        quote = text[at : at + size]
        share = rng.choice([0, 0, 0.01, 0.04, 0.1])
        if rng.random() < 0.4:  # more copies, some of them changed
            for _ in range(rng.randint(1, 4)):
                text += " " + edited(rng, quote, rng.choice([0, 0.02]))
        yield i, text, edited(rng, quote, share)


@pytest.mark.parametrize(("how", "rounds"), [(align.Matching(), 2), (align.Matching(threshold=0.75, min_step=4, padding=10), 1), (align.Matching(threshold=0.6, min_step=2, padding=0), 0)])
def test_joins_find_what_the_search_finds(spark, how, rounds):
    rng = random.Random(rounds)
    rows = [*cases(rng, 90), (1000, None, "a"), (1001, "a", None), (1002, "", "a"), (1003, "a", "")]
    pairs = spark.createDataFrame([(i, 0, q) for i, _, q in rows], "doc long, n int, quote string")
    texts = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc long, text string")
    got = {}
    for r in fuzzy.near_spans(pairs, texts, ["doc"], ["n"], how, rounds).collect():
        got.setdefault(r.doc, []).append((r.begin, r.end, round(r.score, 9), r.status))
    want = {i: [(b, e, round(s, 9), x) for b, e, s, x in found] for i, t, q in rows if (found := align.spans(t, q, how))}
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(x) for i, x in want.items()}


def test_few_windows_are_compared(spark):
    """Of a long section's windows only those that hold the quote survive the join."""
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(4000))
    quote = edited(rng, text[9000:9400], 0.02)
    open_ = spark.createDataFrame([(1, quote, len(quote), len(text), 0)], "doc long, quote string, q int, n int, rest int")
    texts = spark.createDataFrame([(1, text)], "doc long, text string")
    assert fuzzy.windows(open_, ["doc"], align.Matching()).count() > 200
    left = [r.start for r in fuzzy.candidates(open_, texts, ["doc"], [], align.Matching()).collect()]
    assert 1 <= len(left) <= 3 and all(8600 <= x <= 9100 for x in left)


def test_exact_mentions_need_no_python(spark):
    pairs = spark.createDataFrame([(1, "ab")], "doc long, quote string")
    texts = spark.createDataFrame([(1, "xx ab ab")], "doc long, text string")
    found = fuzzy.near_spans(pairs, texts, ["doc"], [], rounds=1)
    assert sorted((r.begin, r.status) for r in found.collect()) == [(3, "match_exact"), (6, "match_exact")]


def test_blocks_are_difflibs():
    rng = random.Random(3)
    for letters in ("ab", "abcdef", "0123456789abcdef§𝄞"):
        for _ in range(150):
            window = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
            at = rng.randrange(len(window) + 1)
            quote = edited(rng, window[at : at + rng.randint(0, 40)], 0.1)
            pair = difflib.SequenceMatcher(None, quote, window, autojunk=False)
            block = pair.find_longest_match()
            assert align.compared(quote, window) == (pair.ratio(), block.b - block.a)


def test_pairs_of_one_file_are_dealt_out(spark):
    """A hundred thousand pairs of one split are not left to one task."""
    pairs = spark.range(0, 100_000, 1, 1).select("id", F.concat(F.repeat(F.lit("ab "), 20), F.col("id").cast("string")).alias("text"), F.col("id").cast("string").alias("quote"))
    assert align.align(pairs).rdd.getNumPartitions() > 1


def test_grams_take_one_pass(spark):
    """Grams of a long text, characters outside the basic plane among them; they took time by the square of its length."""
    text = "".join(random.Random(5).choice("abc \n𝄞é") for _ in range(50_000))
    found = spark.createDataFrame([(text,), ("ab",), ("",)], "text string").select(fuzzy._grams(F.col("text")).alias("g")).collect()
    assert [r.g for r in found] == [[text[i : i + 3] for i in range(len(text) - 2)], [], []]


@pytest.mark.parametrize("rounds", [0, 2])
def test_whole_places_are_what_the_search_finds(spark, rounds):
    how, rng = align.Matching(threshold=0.8, padding=30, whole=True), random.Random(7)
    rows = [*cases(rng, 90), (1000, None, "a"), (1001, "a", None), (1002, "", "a"), (1003, "a", "")]
    pairs = spark.createDataFrame([(i, 0, q) for i, _, q in rows], "doc long, n int, quote string")
    texts = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc long, text string")
    got = sorted((r.doc, r.begin, r.end, round(r.score, 9), r.status) for r in fuzzy.near_spans(pairs, texts, ["doc"], ["n"], how, rounds).collect())
    assert got == sorted((i, b, e, round(s, 9), x) for i, t, q in rows for b, e, s, x in align.spans(t, q, how))
    assert any(x == "match_fuzzy" for *_, x in got)


def test_windows_that_cut_a_passage_dont_count_as_whole(spark, tmp_path):
    """Passages at the end of documents, where a short window that cuts them is nearer, and twice in one, against the SQL."""
    rng = random.Random(11)
    passage = {i: "".join(rng.choice("abcdefghij klmnop") for _ in range(size)) for i, size in enumerate((81, 120, 208, 310, 394))}
    docs = []
    for i, text in passage.items():
        for behind in (0, 9, 40, 300):
            docs += ["q" * rng.randrange(400) + text + "z" * behind, "q" * rng.randrange(400) + (text + "z" * behind) * 2 + text]
    spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(passage.items()), "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    got = sorted(tuple(r) for r in QUERIES["align_near_passages"](spark, str(tmp_path)).collect())
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"create view {name} as from '{tmp_path}/{name}.parquet/*.parquet'")
    want = sorted(db.execute(ORACLE["align_near_passages"]).fetchall())
    assert got == want and {"as it is", "edited"} == {r[2] for r in got}


def test_no_side_of_grams_or_windows_goes_by_way_of_the_driver(spark, tmp_path):
    """Small files of quotes stand for many grams and windows, which the planner took for small and broadcast."""
    keep = keeper(str(tmp_path))
    open_ = keep(spark.createDataFrame([(1, "ab" * 50, 100, 400, 0)], "doc long, quote string, q int, n int, rest int"), "open")
    texts = keep(spark.createDataFrame([(1, "ab" * 200)], "doc long, text string"), "texts")
    pairs = keep(spark.createDataFrame([(1, "ab" * 49 + "a§")], "doc long, quote string"), "pairs")
    for found in (fuzzy.candidates(open_, texts, ["doc"], [], align.Matching()), fuzzy.near_spans(pairs, texts, ["doc"], [], align.Matching(whole=True), keep=keep)):
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
        assert found.count()
