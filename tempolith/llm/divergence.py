"""How far the sources of a language differ in their words.

1. *Sketch.*  Each task counts in how many of its documents a term occurs, in a count-min
   sketch of fixed size over (language, term) whose cells stop at the least count that
   matters.  Sketches are merged by adding, in two levels, so no task meets the sketches of
   all others.  A sum in a cell is never under the count of any of its terms.
2. *Exact counts.*  A second pass counts only terms whose sketch reaches the least count;
   the long tail of rare words is left out before anything is shuffled.  What passes is
   counted exactly, by (language, source, term), and judged by its exact count again.
3. *Pairs.*  A term that neither of two sources has adds the same to their divergence
   whatever the term, one that only one of them has depends on its count alone; so those
   parts follow from how many terms have each count, and only terms that both sources have
   are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import textkernel as tk
from .storage import materialise, release

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
#: cells of one row of the sketch, and its rows; a byte for each cell, so WIDTH * DEPTH bytes are sent out whatever the input
WIDTH, DEPTH = 1 << 21, 4
CHUNK = 1 << 16
BLOCK_BYTES = 4 << 20
#: rows of partial counts that a task holds before it hands them on
HELD = 1 << 20
_SALTS = 64
U = np.uint64

#: bytes of terms: letters, and all bytes of code points beyond ASCII
IS_TERM = np.zeros(256, dtype=bool)
IS_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def terms(block: tk.Block) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(document, code) of every term of a block, and the distinct terms the codes stand for."""
    start, end = tk.runs(IS_TERM[block.data], block.bounds)
    doc = np.searchsorted(block.bounds, start, "right") - 1
    code, words = tk.coded(_LOWER[block.data], start, end)
    return doc, code, words.cast(pa.large_string())


def per_document(doc: np.ndarray, code: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, code) with how often each occurs; codes are below ``many``."""
    key, n = np.unique(doc.astype(np.int64) * many + code, return_counts=True)
    return key // max(1, many), key % max(1, many), n


def _cells(lang: np.ndarray, term: np.ndarray, width: int, depth: int) -> Iterator[np.ndarray]:
    """The cell of (language, term), given by hashes, in each row of the sketch."""
    both = tk.mix(term ^ tk.mix(lang))
    for row, step in enumerate(np.arange(1, depth + 1, dtype=U) * U(0x9E3779B97F4A7C15)):
        yield (tk.mix(both + step) % U(width)).astype(np.int64) + row * width


def _coded(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def sketch(docs: DataFrame, least: int = MIN_DOCS, width: int = WIDTH, depth: int = DEPTH) -> np.ndarray:
    """Merged count-min sketch of document frequencies by (lang, term); cells stop at ``least``.

    ``docs`` has lang, source and text without nulls.
    """

    def added(cells: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
        at, back = np.unique(at, return_inverse=True)
        cells[at] = np.minimum(least, cells[at] + np.bincount(back, weights=n)).astype(np.uint8)

    def chunks(cells: np.ndarray) -> pa.RecordBatch:
        part = cells.reshape(-1, min(CHUNK, width))
        some = np.flatnonzero(part.any(axis=1))
        return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([part[i].tobytes() for i in some], pa.binary())], names=["chunk", "cells"])

    @tk.tidied
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(width * depth, np.uint8)
        for batch in batches:
            lang, langs = _coded(batch.column(0))
            lang_hash = tk.hashes(langs)
            for block in tk.blocks(batch.column(1), BLOCK_BYTES):
                doc, code, words = terms(block)
                if not len(code):
                    continue
                d, c, _ = per_document(doc, code, len(words))
                of = lang[block.first : block.first + block.size][d].astype(np.int64)
                key, n = np.unique(of * len(words) + c, return_counts=True)
                for at in _cells(lang_hash[key // len(words)], tk.hashes(words)[key % len(words)], width, depth):
                    added(cells, at, n)
        yield chunks(cells)

    @tk.tidied
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, cells in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                new = np.frombuffer(cells.as_buffer(), np.uint8)
                # both stay at or below the least count, so their sum fits a byte
                held[chunk] = np.minimum(least, held[chunk] + new) if chunk in held else new
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())], names=["chunk", "cells"])

    if not 0 < least <= 127:
        raise ValueError("the least count must be from 1 to 127")
    kind = "chunk int, cells binary"
    own = docs.select("lang", "text").mapInArrow(count, kind).withColumn("task", F.spark_partition_id())
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a task merges a part of the tasks' sketches of a chunk, then another the sums of all such parts
    first = own.repartition(parts, "chunk", F.col("task") % _SALTS).select("chunk", "cells").mapInArrow(merge, kind)
    whole = np.zeros((width * depth // min(CHUNK, width), min(CHUNK, width)), np.uint8)
    for row in first.repartition(parts, "chunk").mapInArrow(merge, kind).collect():
        whole[row["chunk"]] = np.frombuffer(row["cells"], np.uint8)
    return whole.reshape(-1)


def counted(docs: DataFrame, shared: Broadcast, least: int = MIN_DOCS, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """(lang, source, term, n, df): occurrences and documents of terms that the sketch lets pass, partial for each task."""

    @tk.tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        held: list[pa.Table] = []

        def summed() -> pa.Table:
            found = pa.concat_tables(held).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("df", "sum")])
            return found.rename_columns({"n_sum": "n", "df_sum": "df"})

        for batch in batches:
            lang, langs = _coded(batch.column(0))
            source, sources = _coded(batch.column(1))
            lang_hash = tk.hashes(langs)
            group = lang.astype(np.int64) * len(sources) + source
            for block in tk.blocks(batch.column(2), BLOCK_BYTES):
                doc, code, words = terms(block)
                if not len(code):
                    continue
                many = len(words)
                d, c, n = per_document(doc, code, many)
                key, back = np.unique(group[block.first : block.first + block.size][d] * many + c, return_inverse=True)
                df = np.bincount(back)
                total = np.zeros(len(key), np.int64)
                np.add.at(total, back, n)
                of, word = key // many, key % many
                passed = np.ones(len(key), dtype=bool)
                for at in _cells(lang_hash[of // len(sources)], tk.hashes(words)[word], width, depth):
                    passed &= cells[at] >= least
                of, word = of[passed], word[passed]
                columns = [langs.take(pa.array(of // len(sources))), sources.take(pa.array(of % len(sources))), words.cast(pa.string()).take(pa.array(word)), pa.array(total[passed]), pa.array(df[passed])]
                held.append(pa.table(columns, names=["lang", "source", "term", "n", "df"]))
                if sum(t.num_rows for t in held) > HELD:
                    held = [summed()]
                    if held[0].num_rows > HELD // 2:
                        yield from held.pop().to_batches(max_chunksize=1 << 16)
        if held:
            yield from summed().to_batches(max_chunksize=1 << 16)

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n bigint, df bigint")


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exact for any long."""
    top, low = (count.cast("decimal(20,0)") + 2) * F.lit(SCALE), total.cast("decimal(20,0)") + kept.cast("decimal(20,0)") * 2
    return F.call_function("div", top.cast("decimal(38,0)"), low.cast("decimal(38,0)")) + 1


def _apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are below 2^30 + 2, so nothing overflows."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, least: int = MIN_DOCS, top: int = TOP, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """(lang, source, part, item, q, value, rank) for every (lang, source) group of ``docs`` (lang, source, text).

    Part ``pair``: each other source of the language and the divergence from it over all
    kept terms.  Part ``term``: the ``top`` terms that speak most for the source against its
    language.  Nulls count as empty, a row is a document, repeated rows count one by one,
    texts of any length are read whole.  Groups without terms, and languages without kept
    terms, have their pairs too; a language with one source has none.  Ties are ranked by
    the item's bytes.  An empty table has no rows.  Columns besides these are not read.
    """
    docs, spark = _plain(docs), docs.sparkSession
    shared = spark.sparkContext.broadcast(sketch(docs, least, width, depth))
    by = ["lang", "source"]
    counts = counted(docs, shared, least, width, depth).groupBy(*by, "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    counts = materialise(counts, "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df")).where(F.col("df") >= least)
    kept = materialise(kept.select("lang", "term", "lang_n"), "kept")
    own = materialise(counts.join(kept, ["lang", "term"]).select(*by, "term", "n", "lang_n"), "own")
    release(counts)
    langs = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("v"))
    totals = own.groupBy(*by).agg(F.sum("n").alias("total"), F.count("*").alias("many"))
    zero = F.lit(0).cast("long")
    groups = docs.select(*by).distinct().join(totals, by, "left").join(langs, "lang", "left")
    groups = groups.select(*by, *(F.coalesce(c, zero).alias(c) for c in ("total", "many", "lang_total", "v")))
    groups = materialise(groups.withColumn("p0", F.when(F.col("v") > 0, _share(zero, F.col("total"), F.col("v")))), "groups")
    shares = own.join(groups.select(*by, "total", "lang_total", "v", "p0"), by)
    shares = shares.select(*by, "term", _share(F.col("n"), F.col("total"), F.col("v")).alias("p"), _share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"), "p0")
    shares = materialise(shares, "shares")
    release(own, kept)

    # terms: the best of each part of a group, then of these
    speak = shares.where("p > q").select(*by, F.col("term").alias("item"), "q", _apart(F.col("p"), F.col("q")).alias("value"))
    order = [F.col("value").desc(), F.col("item")]
    part = speak.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(_SALTS)))
    some = part.withColumn("rank", F.row_number().over(Window.partitionBy(*by, "salt").orderBy(*order))).where(F.col("rank") <= top).drop("salt")
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
    best = best.select(*by, F.lit("term").alias("part"), "item", "q", "value", "rank")

    # pairs a < b: what one of both has alone, by how many of its terms have each share ...
    shape = materialise(shares.groupBy(*by, "p").agg(F.count("*").alias("k")), "shapes")
    other = groups.where("v > 0").select("lang", F.col("source").alias("other"), F.col("p0").alias("other_p0"))
    lone = shape.join(other, "lang").where("source <> other")
    lone = lone.select("lang", F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b"), (F.col("k") * _apart(F.col("p"), F.col("other_p0"))).alias("f"), zero.alias("common"))
    # ... put right for the terms that both have
    x, y = (shares.select("lang", "term", F.col("source").alias(s), F.col("p").alias(f"p_{s}"), F.col("p0").alias(f"z_{s}")) for s in "ab")
    pa_, pb, za, zb = (F.col(c) for c in ("p_a", "p_b", "z_a", "z_b"))
    both = x.join(y, ["lang", "term"]).where("a < b")
    both = both.select("lang", "a", "b", (_apart(pa_, pb) - _apart(pa_, zb) - _apart(pb, za)).alias("f"), F.lit(1).cast("long").alias("common"))
    parts = materialise(lone.union(both).groupBy("lang", "a", "b").agg(F.sum("f").alias("f"), F.sum("common").alias("common")), "pairs")
    ends = [groups.select("lang", F.col("source").alias(s), F.col("many").alias(f"many_{s}"), F.col("p0").alias(f"z_{s}"), *(["v"] if s == "a" else [])) for s in "ab"]
    pairs = ends[0].join(ends[1], "lang").where("a < b").join(parts, ["lang", "a", "b"], "left")
    none = F.col("v") - F.col("many_a") - F.col("many_b") + F.coalesce("common", zero)
    pairs = pairs.select("lang", "a", "b", F.when(F.col("v") > 0, F.coalesce("f", zero) + none * _apart(za, zb)).otherwise(zero).alias("value"))
    each = pairs.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("s"), "value")
    each = each.select("lang", "s.source", F.lit("pair").alias("part"), "s.item", F.lit(None).cast("long").alias("q"), "value")
    ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.union(best)


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return audit(docs).select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank")
