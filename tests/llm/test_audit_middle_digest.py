"""Source divergence, fill-in-the-middle and the digest index against brute force and their SQL twins."""

import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tempolith.llm import divergence, exact_dedup, fill_in_middle, oracles, queries, storage
from tempolith.llm import textkernel as tk


def rows(frame):
    cols = sorted(frame.columns)
    return cols, sorted((tuple(v) for v in frame[cols].astype(object).where(frame[cols].notna(), None).values.tolist()), key=repr)


@pytest.mark.parametrize("name", ["op11_source_divergence", "op12_fill_in_middle", "op13_digest_index"])
def test_query_equals_sql(spark, sf_dir, name):
    documents = pd.read_parquet(f"{sf_dir}/documents.parquet")  # noqa: F841  DuckDB reads it by its name
    assert rows(queries.QUERIES[name](spark, sf_dir).toPandas()) == rows(duckdb.sql(queries.ORACLE[name]).df())


ODD = [None, "", " ", "a", "A a á Á", "x" * 100_000, "12 34", "<P> in <S> it", "é𝄞 ﷺ\n", "\x00a b", "a", "word " * 5000, "plain text of some words"]


def odd(spark):
    out = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}") for i, t in enumerate(ODD)]
    out += [(3, "a", "en", "s0"), (3, "a", "en", "s0"), (None, "a", "en", "s0"), (None, "only here", None, None), (None, "only here", None, None)]
    return spark.createDataFrame(out, "doc_id long, text string, lang string, source string").withColumns({"n": F.lit("n"), "a.b": F.lit(1), "digest": F.lit("d"), "term": F.lit("t"), "kept": F.lit("k")})


# --- divergence


def brute_audit(docs, least, top):
    """The contract, group by group over all terms."""
    docs = [tuple(x or "" for x in d) for d in docs]
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    df, n = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for lang, source, text in docs:
        found = [w.translate(fold) for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text)]
        df[lang].update(set(found))
        n[lang, source].update(found)
    out = set()
    share = lambda c, total, v: 1 + 10**9 * (c + 2) // (total + 2 * v)
    apart = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in {x[0] for x in docs}:
        kept = [t for t, c in df[lang].items() if c >= least]
        sources = {s for x, s in n if x == lang}
        totals = {s: sum(n[lang, s][t] for t in kept) for s in sources}
        whole, v = {t: sum(n[lang, s][t] for s in sources) for t in kept}, len(kept)
        for s in sources:
            pairs = [(sum(apart(share(n[lang, s][t], totals[s], v), share(n[lang, o][t], totals[o], v)) for t in kept), o) for o in sources - {s}]
            out |= {(lang, s, "pair", o, f, i) for i, (f, o) in enumerate(sorted(pairs, key=lambda x: (-x[0], x[1].encode())), 1)}
            told = []
            for t in kept:
                p, q = share(n[lang, s][t], totals[s], v), share(whole[t], sum(whole.values()), v)
                if n[lang, s][t] and p > q:
                    told.append((apart(p, q), t))
            out |= {(lang, s, "term", t, f, i) for i, (f, t) in enumerate(sorted(told, key=lambda x: (-x[0], x[1].encode()))[:top], 1)}
    return out


@pytest.mark.parametrize(("width", "depth"), [(1 << 16, 2), (8, 1)])
def test_audit_equals_brute_force(spark, width, depth):
    """Also where the sketch is so narrow that it lets nearly all terms pass."""
    rng = random.Random(width)
    words = ["Aa", "bB", "ça", "ÇA", "中文", "𝄞", *(f"w{chr(97 + i // 9)}{chr(97 + i % 9)}" for i in range(60))]
    docs = [(rng.choice(["en", "de", None, "x"]), rng.choice(["s1", "s2", "é", "z", None]), " 1,".join(rng.choice(words[: rng.randint(1, 66)]) for _ in range(rng.choice([0, 3, 40])))) for _ in range(150)]
    docs += [("lone", "only", "aa bb"), ("pair", "p", None), ("pair", "q", "aa"), ("en", "s1", "aa " * 30_000)]
    frame = spark.createDataFrame(docs, "lang string, source string, text string")
    got = {tuple(r) for r in divergence.audit(frame, 4, 3, width, depth).drop("q").select("lang", "source", "part", "item", "value", "rank").collect()}
    assert got == brute_audit(docs, 4, 3)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aBz@[`{é中𝄞 \n\x00", max_size=30), max_size=8))
def test_terms_equal_a_pattern(texts):
    for block in tk.blocks(pa.array(texts, pa.string()), 40):
        doc, code, words = divergence.terms(block)
        words = words.to_pylist()
        for i in range(block.size):
            want = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", texts[block.first + i])
            assert [words[c] for c in code[doc == i]] == [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in want]


def test_the_sketch_never_underestimates(spark):
    rng = random.Random(4)
    docs = [("en", "s", " ".join(chr(97 + int(rng.expovariate(0.3)) % 26) * rng.randint(1, 3) for _ in range(12))) for _ in range(300)]
    frame = spark.createDataFrame(docs, "lang string, source string, text string").repartition(7)
    df = collections.Counter(w for _, _, t in docs for w in set(t.split()))
    cells = divergence.sketch(frame, 10, 64, 3)
    names = pa.array([*df], pa.large_string())
    lang = np.repeat(tk.hashes(pa.array(["en"])), len(df))
    least = np.min([cells[at] for at in divergence._cells(lang, tk.hashes(names.cast(pa.large_binary())), 64, 3)], axis=0)
    assert all(x >= min(10, n) for x, n in zip(least, df.values(), strict=True)) and cells.max() <= 10
    with pytest.raises(ValueError, match="least count"):
        divergence.sketch(frame, 200)


def test_shares_of_very_large_counts_are_exact(spark):
    big = 9_000_000_000_000
    got = spark.range(1).select(divergence._share(F.lit(big), F.lit(3 * big), F.lit(7)).alias("p")).first().p
    assert got == 1 + 10**9 * (big + 2) // (3 * big + 14)


def test_audit_of_odd_rows(spark):
    frame = odd(spark)
    got = {tuple(r) for r in divergence.report(frame).collect()}
    assert got == brute_audit([(r.lang, r.source, r.text) for r in frame.collect()], 10, 10) and got
    assert divergence.report(frame.limit(0)).count() == 0


# --- fill in the middle


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n<P>SMé𝄞", max_size=40), st.integers(-5, 10**12), st.sampled_from(fill_in_middle.UNITS))
def test_pieces_stand_at_the_drawn_units(text, doc_id, unit):
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    out, form, n, i, m = fill_in_middle.cut(points, doc_id, unit)
    h = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    assert n == len(text)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        assert (out, form, i, m) == (text, "plain", None, None)
        return
    units = {"char": list(text), "word": re.findall(r"[\x20\x09-\x0d]+|[^\x20\x09-\x0d]+", text), "line": re.findall(r"[^\n]*\n|[^\n]+", text)}[unit]
    assert "".join(units) == text
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    a, b, c = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    assert (form, i, m) == ("spm" if h4 % 100 < 20 else "psm", len(a), len(b))
    assert out == (f"<S>{c}<P>{a}<M>{b}" if form == "spm" else f"<P>{a}<S>{c}<M>{b}")


@pytest.mark.parametrize("unit", fill_in_middle.UNITS)
def test_texts_are_restored(spark, unit):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab <>PSM\né𝄞") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = fill_in_middle.transform(frame, unit).select("doc_id", "form", fill_in_middle.restored(F.col("output"), F.col("form")).alias("t")).collect()
    assert {r.doc_id: r.t for r in got} == dict(enumerate(texts))
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_odd_rows(spark):
    frame = odd(spark)
    got = fill_in_middle.report(frame).collect()
    sums = collections.Counter((r.doc_id, r.restored_sha256) for r in got)
    assert sums == collections.Counter((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in frame.collect())
    assert all((r.prefix_chars is None) == (r.middle_chars is None) == (r.form == "plain") for r in got)
    with pytest.raises(ValueError, match="names"):
        fill_in_middle.transform(frame)
    names = ("out", "form", "chars", "prefix", "middle")
    full = fill_in_middle.transform(frame, names=names)
    assert full.columns == [*(c for c in frame.columns if c != "text"), *names] and full.where("n = 'n' and `a.b` = 1").count() == frame.count()
    assert fill_in_middle.report(frame.limit(0)).count() == 0


# --- exact dedup


def brute_dedup(docs):
    groups = collections.defaultdict(list)
    for i, t in docs:
        groups[t or ""].append(i)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def test_dedup_of_odd_rows(spark):
    frame = odd(spark)
    got = exact_dedup.report(frame, storage.fresh_path(spark, "index")).collect()
    want = brute_dedup([(r.doc_id, r.text) for r in frame.collect()])
    by = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in want.items()}
    assert len(got) == frame.count()
    assert all((r.keep_id, r.group_size) == by[r.text_sha256] for r in got)
    kept = [r for r in got if r.kept]
    assert all(r.doc_id == r.keep_id for r in kept) and sorted(r.text_sha256 for r in kept) == sorted(by)
    assert exact_dedup.report(frame.limit(0), storage.fresh_path(spark, "index")).count() == 0
    new = exact_dedup.new_documents(frame, exact_dedup.DigestIndex.create(spark, storage.fresh_path(spark, "index")))
    assert new.columns == frame.columns and sorted((r.text or "") for r in new.collect()) == sorted(want)


def test_batches_meet_the_index(spark):
    rng = random.Random(8)
    path, seen = storage.fresh_path(spark, "index"), {}
    index = exact_dedup.DigestIndex.create(spark, path, buckets=4)
    for batch in range(4):
        docs = [(batch * 100 + i, f"text {rng.randint(0, 60)}") for i in range(80)]
        frame = spark.createDataFrame(docs, "doc_id long, text string")
        for _ in range(2):  # the batch again, as after a break: the same rows
            got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.deduplicate(frame, index, str(batch)).collect()}
            own = brute_dedup(docs)
            assert got == {i: (seen.get(t, own[t][0]), own[t][1], t not in seen and i == own[t][0]) for i, t in docs}
        seen = {t: keep for t, (keep, _) in own.items()} | seen
        # another session finds the index in its folder
        index.forget()
        index = exact_dedup.DigestIndex.open(spark, path, 4)
    assert {bytes(r.digest): r.keep_id for r in index.entries().collect()} == {hashlib.sha256(t.encode()).digest(): k for t, k in seen.items()}
    small = index.compacted(storage.fresh_path(spark, "index"))
    assert {tuple(map(str, r)) for r in small.entries().collect()} == {tuple(map(str, r)) for r in index.entries().collect()}
    known = exact_dedup.deduplicate(frame, small, "later").collect()
    assert not any(r.kept for r in known)


def test_the_index_is_not_shuffled(spark):
    path = storage.fresh_path(spark, "index")
    index = exact_dedup.DigestIndex.create(spark, path, buckets=4)
    frame = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "doc_id long, text string")
    exact_dedup.deduplicate(frame, index).count()
    keys = frame.select(exact_dedup.digest(F.col("text")).alias("digest")).repartition(4, "digest")
    plan = keys.join(index.entries().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1


def test_normalised_texts(spark):
    frame = spark.createDataFrame([(1, "A  b"), (2, "a b"), (3, "ab")], "doc_id long, text string")
    index = exact_dedup.DigestIndex.create(spark, storage.fresh_path(spark, "index"))
    got = exact_dedup.deduplicate(frame, index, normalise=lambda t: F.regexp_replace(F.lower(t), r"\s+", " ")).collect()
    assert {r.doc_id: (r.keep_id, r.kept) for r in got} == {1: (2, False), 2: (2, True), 3: (3, True)}
