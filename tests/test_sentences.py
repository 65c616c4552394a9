"""Learned sentences, and sections whose places are summed up within a row."""

import collections
import math
import random
import re
import time

import pytest

from tempolith.operators import sections, sentences

SAID = [
    "Dr. Smith gave 3.5 mg q.d. for some weeks and met Dr. Jones.",
    "The patient was seen by Dr. Jones in pain.",
    "She took 2.5 mg b.i.d. with food!",
    "He had pain and food for weeks after he met the team.",
    "Was it Dr. Who? The dose was 5 mg and Smith had it.",
    "The weeks in which Jones was ill were set aside.",
]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(SAID) for _ in range(20))) for i in range(150)] + [(900, None), (901, "  "), (902, "x.")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def brute(texts):
    """Counts and scores of word types, text by text."""
    dotted, alone = collections.Counter(), collections.Counter()
    for text in texts:
        for w in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
            w = re.sub(r"""[)"'\]}]+$""", "", re.sub(r"""^[("'\[{]+""", "", w))
            if re.search(r"[^.]\.$", w):
                dotted[w[:-1].lower()] += 1
            elif t := re.sub(r"[.,;:!?]+$", "", w).lower():
                alone[t] += 1
    p = sum(dotted.values()) / (sum(dotted.values()) + sum(alone.values()))
    out = {}
    for t, k in dotted.items():
        if re.search(r"[^\W\d_]", t):
            m, inner = alone[t], t.count(".")
            likely = 2 * (k * (math.log(0.99) - math.log(p)) + m * (math.log(0.01) - math.log(1 - p)))
            out[t] = (k, m, likely * math.exp(inner - len(t)) * (inner + 1) * float(len(t) - inner) ** -m)
    return out


def test_scores_equal_brute_force(spark, corpus):
    want = brute([r.text for r in corpus.collect()])
    got = {r.type: r for r in sentences.abbreviation_scores(corpus).collect()}
    assert got.keys() == want.keys()
    for t, (k, m, score) in want.items():
        assert (got[t].with_period, got[t].alone) == (k, m) and math.isclose(got[t].score, score, rel_tol=1e-9, abs_tol=1e-300), t


def test_abbreviations_and_decimals_stay_whole(spark, corpus):
    model = sentences.learn(corpus)
    assert {"dr", "q.d", "b.i.d"} <= model.abbreviations and not {"jones", "food", "weeks", "pain"} & model.abbreviations
    found = [r.text for r in sentences.split(corpus, ("doc_id",), model).collect()]
    assert SAID[0] in found and SAID[1] in found and SAID[2] in found
    assert not any(re.search(r"(Dr\.|3\.|q\.)$", t) for t in found)
    assert sentences.learn(corpus.limit(0)) == sentences.Model(frozenset(), frozenset()) and sentences.split(corpus.limit(0), ("doc_id",), model).count() == 0


def test_sentences_cover_their_text(spark, corpus):
    texts = {r.doc_id: r.text for r in corpus.collect()}
    model, by = sentences.learn(corpus), collections.defaultdict(list)
    for r in sentences.split(corpus, ("doc_id",), model).collect():
        assert texts[r.doc_id][r.begin : r.end] == r.text == r.text.strip()
        by[r.doc_id].append(r.text)
    assert all("".join("".join(by[i]).split()) == "".join((t or "").split()) for i, t in texts.items())


def test_pieces_need_no_shuffle(spark):
    notes = spark.createDataFrame([("p", "d", "A:: one\ntwo. 3.5 é𝄞  end"), ("p", "d", "TITLE::x\n\ny z")], "patient_id string, doc_id string, text string")
    for split in (sections.titled_sections, sections.line_sections, sections.sentences, sections.tokens):
        found = split(notes)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan
        texts = [r.text for r in notes.collect()]
        # two files of one key have places of their own
        rows = found.collect()
        assert rows and all(any(t[r.begin : r.end] == r.text for t in texts) for r in rows)


def test_long_runs_of_spaces(spark):
    notes = spark.createDataFrame([("p", "d", "a" + " " * 200_000 + "b." + " " * 200_000)], "patient_id string, doc_id string, text string")
    assert [(r.begin, r.text) for r in sections.tokens(notes).collect()] == [(0, "a"), (200_001, "b"), (200_002, ".")]


def test_counts_are_made_once_and_before_patterns(spark, tmp_path):
    """All counts of a model stand on one pass, in which spellings are counted; patterns run once for each of them."""
    spark.createDataFrame([(1, "a b.\x0bC\td. E\r\n\ff. G  ")], "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    short = sentences.abbreviation_scores(docs).where("score >= 1e9")
    found = sentences.starter_scores(docs, short)
    assert {(r.type, r.after, r.total) for r in found.collect()} == {("c", 1, 1), ("e", 1, 1), ("g", 1, 1)}
    plan = sentences._types(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("regexp_replace") < plan.index("Exchange") < plan.index("Generate")  # from the last step to the first


def test_long_words_take_one_try():
    """A word without a mark is tried once; it was tried from each of its characters, by the square of its length."""
    model = sentences.Model(frozenset(), frozenset())
    begun = time.perf_counter()
    assert sentences.ends("x" * 200_000 + " a. b", model) == [200_003, 200_005]
    assert time.perf_counter() - begun < 5
