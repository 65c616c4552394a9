"""Rows told apart by id and text; texts that a polynomial hash would take for equal; the weighted measure on the tables."""

import collections

import pyarrow as pa
import pytest

from tempolith.llm import probminhash, quality, queries, spaced_seeds
from tempolith.llm import textkernel as tk


def thue_morse(n, a, b):
    """2^n characters and their complement."""
    word = "".join((a, b)[bin(i).count("1") % 2] for i in range(1 << n))
    return word, word.translate(str.maketrans(a + b, b + a))


@pytest.mark.parametrize("n", range(8, 14))
def test_words_and_lines_that_a_polynomial_confuses(n):
    x, y = thue_morse(n, "a", "b")
    found = quality.block_features(next(tk.blocks(pa.array([f"{x}\n{y}\n{x}", f"{y} {x}"]), 1 << 30)))
    assert found["n_dup_lines"].tolist() == [1, 0]
    w = tk.words(next(tk.blocks(pa.array([f"{x} {y} {x}"]), 1 << 30)))
    assert w.hash[0] == w.hash[2] != w.hash[1]


def test_texts_that_a_polynomial_confuses(spark):
    x, y = thue_morse(11, "a", "b")
    frame = spark.createDataFrame([(1, x), (2, y), (3, x), (4, f"{x} {y}")], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in probminhash.near_duplicates(frame).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4}
    bench = spark.createDataFrame([(1, " ".join([x] * 3))], "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join([y] * 3)), (2, f"here {x} {x} {x} there")], "doc_id long, text string")
    assert [r.doc_id for r in spaced_seeds.overlaps(docs, bench).collect()] == [2]


A, B, C, D = (" ".join(f"{w}{i}" for i in range(40)) for w in "abcd")


@pytest.mark.parametrize("weighted", [False, True])
def test_of_an_id_with_several_texts_each_is_judged_alone(spark, weighted):
    frame = spark.createDataFrame([(3, A), (5, A), (5, B), (7, C), (7, C), (8, D), (9, f"{D} more"), (4, f"{D} words"), (None, D)], "doc_id long, text string")
    kept = sorted(probminhash.thinned(frame, weighted).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [(r.doc_id, r.text) for r in kept] == [(3, A), (4, f"{D} words"), (5, B), (7, C), (None, D)]
    classes = {(r.doc_id, bytes(r.text_key)): (r.class_id, r.place) for r in probminhash.classes(frame, weighted=weighted).collect()}
    assert len(classes) == 8 and sorted(c for c, _ in classes.values()) == [3, 3, 4, 4, 4, 4, 5, 7]


def test_decontamination_of_an_id_with_several_texts(spark):
    docs = spark.createDataFrame([(1, A), (1, B), (2, f"x {A}")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, A)], "item_id long, text string")
    assert [(r.doc_id, r.text) for r in spaced_seeds.decontaminate(docs, bench).collect()] == [(1, B)]
    assert spaced_seeds.decontaminate(docs.limit(0), bench).count() == 0


def test_overlaps_of_repeated_and_very_long_rows(spark):
    long = "filler words go on " * 60_000 + A
    docs = spark.createDataFrame([(1, A), (1, A), (2, long), (3, "x" * 200_000), (None, None)], "doc_id long, text string").selectExpr("*", "1 as matched_words", "2 as `a.b`")
    got = sorted((r.doc_id, r.matched_words, r.first_word) for r in spaced_seeds.overlaps(docs, spark.createDataFrame([(1, A)], "item_id long, text string")).collect())
    assert got == [(1, 40, 0), (1, 40, 0), (2, 40, 240_000)]


def test_classes_equal_brute_force_probability_jaccard(spark, sf_dir):
    """Classes and links by counts as weights over the whole table, from all pairs of different texts that share a shingle."""
    rows = [(r.doc_id, r.text or "") for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    first = {}
    for i, t in sorted(rows):
        first.setdefault(t, i)
    weights, by, parent, links = {}, collections.defaultdict(set), {i: i for i, _ in rows}, collections.Counter()
    for t, i in first.items():
        w = t.translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ")
        w = [x for x in w if x]
        weights[i] = collections.Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])
        for s in weights[i]:
            by[s].add(i)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def similarity(a, b):
        x, y = weights[a], weights[b]
        both = [*x.keys() | y.keys()]
        return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in both) for i in x.keys() & y.keys())

    for a, b in {(a, b) for ids in by.values() for a in ids for b in ids if a < b}:
        common, union = sum((weights[a] & weights[b]).values()), sum((weights[a] | weights[b]).values())
        if common < 0.5 * union:  # far below; the full sum is costly
            continue
        if similarity(a, b) >= 0.8 - 1e-9:
            links.update((a, b))
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.class_id, r.n_links) for r in probminhash.near_duplicates(queries.table(spark, sf_dir, "documents"), weighted=True).collect()}
    assert got == {i: (find(first[t]), links[first[t]]) for i, t in rows}
