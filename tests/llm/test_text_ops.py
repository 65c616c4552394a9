"""Encoding, language, quality, decontamination and near duplicates against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tempolith.llm import components, langid, oracles, probminhash, quality, queries, sentencepiece_codec, spaced_seeds
from tempolith.llm import textkernel as tk

ODD = [None, "", " ", "   ", "a", "a ", " a  b ", "▁", "x▁y", "\n\nfoo bar\n", "\x00a", "<s>", "é𝄞 ﷺ", "﻿ a", "\n", " \n \n", "a\r\nb\tc d", "</s> <unk>", "1234 5678", "word " * 4000, "x" * 50_000]
MODEL = public_tokenizers.path(queries.MODEL)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return queries.table(spark, sf_dir, "documents").toPandas()


def odd_rows(spark, extra=""):
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 2 else "s", -1, 1.0) for i, t in enumerate(ODD)]
    rows += [(0, ODD[5], "en", "s", -1, 1.0), (0, ODD[5], "en", "s", -1, 1.0), (None, "some text here", "en", "s", -1, 1.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double")


def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_encoding_equals_the_library(spark, sf_dir, docs):
    sp = library()
    got = {r.doc_id: r for r in queries.op1_sentencepiece(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        ids = sp.encode(text or "", add_bos=True, add_eos=True)
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == want


def test_encoding_of_odd_texts(spark):
    sp = library()
    rows = sentencepiece_codec.encode(odd_rows(spark).where("doc_id is null or doc_id > 0"), MODEL).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        text = "some text here" if r.doc_id is None else ODD[r.doc_id]
        ids = sp.encode(text or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.decoded == sp.decode(ids)
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(odd_rows(spark), MODEL), MODEL)
    assert {r.decoded for r in back.collect()} >= {"", "a ", "some text here"}
    assert sentencepiece_codec.digests(odd_rows(spark).limit(0), MODEL).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" ▁\n\tab.é<>0"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=5))
def test_chunk_table_round_trip(texts):
    sp = library_once()
    ids, decoded = sentencepiece_codec.chunk_table(MODEL).encode(pa.array(texts, pa.string()))
    for t, i, d in zip(texts, ids.to_pylist(), decoded.to_pylist(), strict=True):
        want = sp.encode(t, add_bos=True, add_eos=True)
        assert np.frombuffer(i, "<u4").tolist() == want and d == sp.decode(want)


_library = []


def library_once():
    if not _library:
        _library.append(library())
    return _library[0]


def test_chunk_table_that_overflows():
    table = sentencepiece_codec.ChunkTable(MODEL, max_entries=3)
    ids, _ = table.encode(pa.array(["one two three four five", "two six"]))
    assert np.frombuffer(ids[1].as_py(), "<u4").tolist() == library_once().encode("two six", add_bos=True, add_eos=True)


# --- languages


def test_held_out_accuracy(spark, sf_dir, docs):
    got = queries.op10_rank_profiles(spark, sf_dir).toPandas().merge(docs, on="doc_id")
    assert len(got) == len(docs) and got.score.between(0, 1).all()
    held = got[got.held_out]
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert (held.lang == held.lang_pred).mean() > 0.95


def brute_grams(text):
    words = re.findall(r"[^\W\d_]+", text.lower())
    out = collections.Counter()
    for w in words:
        for n in (1, 2, 3):
            padded = w if n == 1 else f"_{w}_"
            out.update(padded[i : i + n] for i in range(len(padded) - n + 1))
    return out


def spelled(gram):
    return "".join("_" if c == 1 else chr(c) for c in (gram >> 42, gram >> 21 & 0x1FFFFF, gram & 0x1FFFFF) if c)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abcdé .,1\n", max_size=40), min_size=1, max_size=4))
def test_grams_equal_brute_force(texts):
    found = langid.grams(pa.array(texts))
    for i, t in enumerate(texts):
        got = {spelled(int(g)): int(n) for d, g, n in zip(found.doc, found.gram, found.count, strict=True) if d == i}
        assert got == brute_grams(t)


def test_distance_equals_brute_force(docs):
    texts = docs.text.tolist()[:60]
    by = {"x": texts[:20], "y": texts[20:40]}
    rows, ranks = [], {}
    for lang, own in by.items():
        total = collections.Counter()
        codes = {}
        for t in own:
            g = langid.grams(pa.array([t]))
            for c, n in zip(g.gram.tolist(), g.count.tolist(), strict=True):
                total[c] += n
                codes[c] = c
        top = sorted(total, key=lambda c: (-total[c], c))[: langid.PROFILE]
        rows += [(lang, r, c) for r, c in enumerate(top)]
        ranks[lang] = {c: r for r, c in enumerate(top)}
    langs, scores = langid.Profiles(rows).predict(pa.array(texts))
    for t, lang, score in zip(texts, langs, scores, strict=True):
        g = langid.grams(pa.array([t]))
        own = sorted(zip(g.gram.tolist(), g.count.tolist(), strict=True), key=lambda x: (-x[1], x[0]))[: langid.PROFILE]
        distance = {k: sum(abs(i - v[c]) if c in v else langid.PROFILE for i, (c, _) in enumerate(own)) for k, v in ranks.items()}
        best = min(sorted(distance), key=distance.get)
        assert lang == best and abs(score - (1 - distance[best] / (len(own) * langid.PROFILE))) < 1e-9


def test_languages_of_odd_texts(spark):
    got = langid.identify(odd_rows(spark)).collect()
    assert len(got) == len(ODD) + 3
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 18)} == {"und"}
    assert langid.identify(odd_rows(spark).limit(0)).count() == 0
    unlabelled = odd_rows(spark).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


# --- quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_features(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    at = collections.defaultdict(list)
    for i in range(len(words) - 4):
        at[tuple(words[i : i + 5])].append(i)
    cover = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(cover)


def test_quality_counts(spark, sf_dir, docs):
    got = {r.doc_id: r for r in queries.op9_adaptive_quality(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for i, t in zip(docs.doc_id, docs.text, strict=True):
        r, want = got[i], brute_features(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r.base_failed and r.kept)
    good = [r for r in got.values() if not r.base_failed]
    assert sum(r.kept for r in good) > 0.8 * len(good)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab #\né\t\r", max_size=60), min_size=1, max_size=4))
def test_quality_counts_of_any_text(texts):
    for block in tk.blocks(pa.array(texts), 50):
        found = quality.block_features(block)
        for i in range(block.size):
            assert tuple(int(found[n][i]) for n in quality.FEATURES[:5]) == brute_features(texts[block.first + i])


def test_fences_of_sketches(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("w" * rng.randint(3, 6) for _ in range(60)), "en", "a") for i in range(400)]
    rows += [(1000, " ".join("w" * 30 for _ in range(12)) + " extra words", "en", "a"), (1001, "ab# " * 3 + " ".join(f"w{i}#" for i in range(60)), "en", "rare"), (1002, None, None, None)]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    judged = [got[i].kept for i in range(400) if not got[i].base_failed]
    assert all(judged) and not got[1001].kept and got[1002].base_failed
    assert len(got) == len(rows)


def test_quality_of_odd_rows(spark):
    assert quality.judge(odd_rows(spark)).count() == len(ODD) + 3
    assert quality.judge(odd_rows(spark).limit(0)).count() == 0


def test_quality_equals_sql(spark, sf_dir, docs):
    import duckdb

    with duckdb.connect() as db:
        db.register("documents", docs)
        want = db.execute(oracles.ADAPTIVE_QUALITY).fetchall()
    got = queries.op9_adaptive_quality(spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(want) and 0 < sum(not r.kept for r in got) < 0.5 * len(got)


def test_fences_move_smoothly_with_the_size_of_a_cell(spark):
    """One document more or less never moves a fence by much: nothing is switched by size."""
    rng = random.Random(6)
    wide = [("en", "big", rng.uniform(4, 6)) for _ in range(3000)]
    own = [("en", "small", rng.uniform(8, 9)) for _ in range(400)]
    fence = {}
    for n in (1, 2, 100, 199, 200, 201, 400):
        frame = spark.createDataFrame(wide + own[:n], "lang string, source string, word_length double").selectExpr("*", *(f"0.0D as {m}" for m in quality.METRICS if m != "word_length"))
        fence[n] = {r.source: r.word_length_high for r in quality.thresholds(frame).collect()}["small"]
    assert fence[1] < fence[100] < fence[200] < fence[400]
    assert abs(fence[200] - fence[199]) < 0.05 and abs(fence[201] - fence[200]) < 0.05 and abs(fence[2] - fence[1]) < 0.05


# --- decontamination


def test_decontamination(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(2000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = {i: text(40) for i in range(20)} | {20: text(6)}
    docs, want = [], set()
    for i in range(120):
        body = text(200)
        if i % 3 == 0:
            item = items[i % 21].copy()
            for k in range(0, len(item), 9):  # a word in nine replaced
                if len(item) > 10:
                    item[k] = "changed"
            at = rng.randint(0, 200)
            body[at:at] = item
            want.add((i, i % 21))
        elif i % 3 == 1:
            body[50:50] = items[i % 20][:9]  # too short a stretch
        docs.append((i, " ".join(body)))
    docs += [(500, None), (501, ""), (None, " ".join(items[3]))]
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items.items()] + [(30, None), (31, ""), (32, " ".join(items[0]))], "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id")
    for limit in (1 << 20, 400):  # the second needs several passes
        got = spaced_seeds.overlaps(frame, bench, max_broadcast=limit).collect()
        assert {(r.doc_id, r.item_id) for r in got if r.doc_id is not None} == want
        assert [r.item_id for r in got if r.doc_id is None] == [3]
    left = {r.doc_id for r in spaced_seeds.decontaminate(frame, bench).collect()}
    assert left == {d for d, _ in docs} - {d for d, _ in want}
    assert spaced_seeds.overlaps(frame, bench.limit(0)).count() == 0 == spaced_seeds.overlaps(frame.limit(0), bench).count()


def test_verbatim_items_are_found(spark, sf_dir, docs):
    bench = queries.table(spark, sf_dir, "benchmark").toPandas()
    want = {(d, i) for d, t in zip(docs.doc_id, docs.text, strict=True) for i, b in zip(bench.item_id, bench.text, strict=True) if b in (t or "")}
    assert want <= {(r.doc_id, r.item_id) for r in queries.op6_spaced_seeds(spark, sf_dir).collect()}


# --- near duplicates


def brute_classes(docs):
    sets, parent = {}, {}
    for i, t in docs:
        w = WORD.findall(t or "")
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)

    by, common = collections.defaultdict(list), collections.Counter()
    texts = {}
    for i, t in docs:
        join(i, texts.setdefault(t or "", i))
        for s in sets[i]:
            common.update((j, i) for j in by[s])
            by[s].append(i)
    for (a, b), n in common.items():
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            join(a, b)
    return {i: find(i) for i, _ in docs}


def test_classes_equal_brute_force(spark, sf_dir, docs):
    got = {r.doc_id: r.class_id for r in queries.op5_probminhash(spark, sf_dir).collect()}
    assert got == brute_classes(list(zip(docs.doc_id.tolist(), docs.text.tolist(), strict=True)))


def test_classes_of_a_family(spark):
    """Versions of one text at all distances, many of which the bucket's least id doesn't resemble."""
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 500)}" for _ in range(300)]
    rows = []
    for i in range(250):
        t = base.copy()
        for _ in range(rng.choice([0, 1, 2, 4, 6, 8, 12, 20])):
            t[rng.randrange(300)] = f"x{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(t)))
    rows += [(900, None), (901, ""), (902, "a b"), (903, "a  b"), (904, "a b c"), (905, " "), (906, "a b")]
    got = {r.doc_id: r.class_id for r in probminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows)


def test_near_duplicates_of_odd_rows(spark):
    got = probminhash.near_duplicates(odd_rows(spark)).collect()
    assert len(got) == len(ODD) + 3
    assert probminhash.near_duplicates(odd_rows(spark).limit(0)).count() == 0


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(0)
    pool = tk.mix(np.arange(1, 141, dtype=np.uint64))
    w = rng.integers(1, 5, 140).astype(float)
    a, b = np.arange(0, 100), np.arange(40, 140)
    doc = np.repeat([0, 1], 100)
    sig = probminhash.signatures(doc, np.concatenate([pool[a], pool[b]]), np.concatenate([w[a], w[b]]), 2, 4096)
    pa_, pb = np.zeros(140), np.zeros(140)
    pa_[a], pb[b] = w[a] / w[a].sum(), w[b] / w[b].sum()
    want = sum(1 / np.maximum(pa_ / pa_[d], pb / pb[d]).sum() for d in range(140) if pa_[d] and pb[d])
    assert abs((sig[0] == sig[1]).mean() - want) < 0.03
    one = probminhash.signatures(np.array([0]), pool[:1], np.ones(1), 2, 64)
    assert len(set(one[0])) == 1 and not one[1].any()


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components(spark, edges):
    parent = {n: n for e in edges for n in e if e[0] != e[1]}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    frame = spark.createDataFrame(edges, "src long, dst long")
    got = [tuple(r) for r in components.connected_components(frame).collect()]
    assert dict(got) == {n: find(n) for n in parent} and len(got) == len(parent)


def test_classes_of_repeated_lines(spark):
    """Copies whose last words are repeated have nearly the same set of shingles, but other counts."""
    rng = random.Random(7)
    rows = []
    for i in range(40):
        words = [f"v{rng.randint(0, 10**6)}" for _ in range(60 if i % 2 else 120)]
        tail = words[-12:] if i % 2 else words[-40:]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words + tail * rng.choice([20, 30, 40])))]
    got = {r.doc_id: r.class_id for r in probminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows) == {i: i - i % 2 for i, _ in rows}


def test_every_overlap_of_a_short_item_is_found(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = {n: [f"i{n}_{k}" for k in range(n)] for n in range(1, 24)}
    docs, want = [], set()
    for n, item in items.items():
        for trial in range(25):
            for misses in {n // 4, n // 4 + 1}:
                text = item.copy()
                for k in rng.sample(range(n), misses):
                    text[k] = "changed"
                body = [rng.choice(vocabulary) for _ in range(30)]
                at = rng.choice([0, 30, rng.randint(0, 30)])
                body[at:at] = text
                docs.append((len(docs), " ".join(body)))
                same = [x == y for x, y in zip(text, item, strict=True)]
                stretch = any(sum(same[a:b]) >= max(12, 0.75 * (b - a)) for a in range(n) for b in range(a + 1, n + 1))
                if sum(same) >= 0.75 * n or stretch:
                    want.add((len(docs) - 1, n, sum(same) >= 0.75 * n))
    bench = spark.createDataFrame([(n, " ".join(t)) for n, t in items.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in spaced_seeds.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    whole = {(d, n) for d, n, all_ in want if all_}
    print("missed", len(whole - got), "of", len(whole))
    assert whole <= got <= {(d, n) for d, n, _ in want}


def test_all_stretches_of_an_item_are_tested():
    item = [f"i{k}" for k in range(52)]
    # twelve equal words qualify; what follows scores more, but is too thin to qualify with them
    text = [w if k < 12 or (k - 12) % 8 > 2 else "changed" for k, w in enumerate(item)]
    index = spaced_seeds.Index.build([(0, " ".join(item))])
    words = tk.words(next(tk.blocks(pa.array([" ".join(text)]))))
    found = index.overlap(words.hash, 0, 0)
    assert found and found[0] >= 12 and found[0] >= 0.75 * (found[2] - found[1] + 1)


@pytest.mark.parametrize("span", [None, 16, 24, 40])
def test_recall_of_seeds_by_length_and_rate(span):
    """Of all overlaps that verification accepts, by a scan without seeds, at least 0.9 are found: whole items, and stretches of items of 60 words."""
    rng = random.Random(span or 1)
    for length in [span] if span else [1, 2, 3, 4, 5, 6, 8, 10, 12, 16, 20, 25, 32, 59]:
        for rate in (0, 0.05, 0.1, 0.15, 0.2, 0.25):
            items = [[f"t{t}w{k}" for k in range(60 if span else length)] for t in range(150)]
            index = spaced_seeds.Index.build([(i, " ".join(t)) for i, t in enumerate(items)])
            texts = []
            for item in items:
                at = rng.randint(0, len(item) - length)
                part = [w if rng.random() >= rate else "changed" for w in item[at : at + length]]
                lead = [f"x{rng.random()}" for _ in range(at + 3)]
                texts.append(" ".join(lead + part + ["y"] * rng.randint(0, 9)))
            w = tk.words(next(tk.blocks(pa.array(texts), 1 << 30)))
            diagonals = {(t, t, d) for t in range(150) for d in range(min(64, w.first[t + 1] - w.first[t]))}
            text = lambda t: w.hash[w.first[t] : w.first[t + 1]]  # noqa: E731, B023
            accepted = {(t, i) for t, i, d in diagonals if index.overlap(text(t), i, d)}
            found = {(t, i) for part in index.hits(w) for t, i, d in part if index.overlap(text(t), i, d)}
            assert found <= accepted and len(found) >= 0.9 * len(accepted), (length, rate, len(found), len(accepted))


def test_hits_of_a_seed_that_many_share(monkeypatch):
    monkeypatch.setattr(spaced_seeds, "CHUNK", 64)  # many chunks, same result
    boiler = " ".join(f"b{k}" for k in range(20))
    index = spaced_seeds.Index.build([(i, f"{boiler} own{i} item{i}") for i in range(40)])
    w = tk.words(next(tk.blocks(pa.array([f"{boiler} and {boiler}", "nothing here", boiler]))))
    parts = list(index.hits(w))
    assert len(parts) > 10
    assert {(t, i) for part in parts for t, i, d in part if index.overlap(w.hash[w.first[t] : w.first[t + 1]], i, d)} == {(t, i) for t in (0, 2) for i in range(40)}


def brute_probability_jaccard(x, y):
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in {*x, *y}) for i in x if i in y)


def test_probability_jaccard_equals_brute_force():
    rng = random.Random(11)
    for _ in range(200):
        x, y = ({k: rng.randint(1, 6) for k in rng.sample(range(30), rng.randint(1, 25))} for _ in range(2))
        sides = [(np.array(sorted(d), np.uint64), np.array([d[k] for k in sorted(d)])) for d in (x, y)]
        got = probminhash.probability_jaccard(*sides[0], *sides[1])
        assert abs(got - brute_probability_jaccard(x, y)) < 1e-9
    ones = [(np.arange(0, 10, dtype=np.uint64), np.ones(10)), (np.arange(5, 20, dtype=np.uint64), np.ones(15))]
    assert abs(probminhash.probability_jaccard(*ones[0], *ones[1]) - 5 / 20) < 1e-12  # of sets, Jaccard


def edited_texts(rng, families, copies, repeats):
    """Families of texts with edits of all sizes, some with a line that stands many times."""
    rows = []
    for _ in range(families):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.randint(8, 160))]
        line = [f"l{rng.randrange(4000)}" for _ in range(12)]
        for _ in range(copies):
            text = base.copy()
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text + line * rng.choice(repeats))))
    return rows


@pytest.mark.parametrize("weighted", [False, True])
def test_recall_of_links_against_brute_force(spark, weighted):
    """Of the pairs of different texts at 0.8 or more, by all shingles, 0.95 at least end in one class."""
    rows = edited_texts(random.Random(21), 60, 7, [0, 0, 1, 3, 40] if not weighted else [0, 0, 2, 2, 5])
    got = {r.doc_id: r.class_id for r in probminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), weighted=weighted).collect()}
    counts = {i: collections.Counter(tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)) for i, t in rows}
    linked, met, parent = 0, 0, {i: i for i, _ in rows}
    for i, _ in rows:
        for j in range(i + 1, min(len(rows), i + 7)):
            x, y = counts[i], counts[j]
            like = brute_probability_jaccard(x, y) if weighted else len({*x} & {*y}) / max(1, len({*x} | {*y}))
            if like >= 0.8:
                linked += 1
                met += got[i] == got[j]
                parent[j] = min(parent[j], parent[i])
    assert linked > 300 and met >= 0.95 * linked, (met, linked)
    # no class holds texts that no chain of such links joins
    families = collections.defaultdict(set)
    for i, c in got.items():
        families[c].add(i // 7)
    assert all(len(f) == 1 for f in families.values())


def test_sketches_tell_unlike_texts_apart():
    """Bits of unequal registers are fair coins, also where few shingles fill all registers; at 0.8 the reach loses nothing."""
    rng = np.random.default_rng(3)
    assert probminhash.reach(96, 0.8) == 26
    far, near = [], []
    for n, common in ((300, 100), (5, 4), (45, 40)):  # Jaccard 0.2, 0.8 and 0.89
        for _ in range(150):
            pool = rng.integers(1, 1 << 62, 2 * n).astype(np.uint64)
            x, y = pool[:n], np.concatenate([pool[:common], pool[n : 2 * n - common] if n == 300 else pool[:0]])
            doc = np.repeat([0, 1], [len(x), len(y)])
            sig = probminhash.signatures(doc, np.concatenate([x, y]), np.ones(len(doc)), 2)
            a, b = probminhash.sketches(sig)
            apart = sum(((int(i) ^ int(j)) & (1 << 64) - 1).bit_count() for i, j in zip(a, b, strict=True))
            like = len({*x.tolist()} & {*y.tolist()}) / len({*x.tolist()} | {*y.tolist()})
            (near if like >= 0.8 else far).append(apart)
    assert max(near) <= 26 and abs(np.mean(far) - 96 * 0.4) < 1 and np.mean([f > 26 for f in far]) > 0.95


def test_encoder_works_on_small_blocks():
    """Blocks of whole texts stay small, so that a worker's memory does, and change nothing in the result."""
    texts = pa.array([f"word{i} " * 2000 + "\n" for i in range(400)] + [None, ""], pa.string())
    parts = list(sentencepiece_codec.text_blocks(texts))
    assert max(pc.sum(pc.binary_length(p)).as_py() for p in parts) <= 1 << 20 and sum(map(len, parts)) == len(texts)
    codec = sentencepiece_codec.chunk_table(MODEL)
    ids, decoded = codec.encode(texts)
    told = [codec.encode(p) for p in parts]
    assert pa.concat_arrays([x for x, _ in told]).equals(ids) and pa.concat_arrays([x for _, x in told]).equals(decoded)
