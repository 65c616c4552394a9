"""Quality rules with adaptive thresholds.

Each (language, source) cell has a mergeable quantile sketch of each metric: counts in
buckets whose bounds grow by ``GAMMA`` (relative error below (GAMMA-1)/2).  Merging is
adding, so cells sum to languages and to the corpus without a second pass, and the result
depends neither on the order of rows nor on their partition.  A metric's fence lies
``REACH`` times the spread between the quartiles outside them; documents beyond a fence go.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import textkernel as tk
from .storage import mapped, materialise

WINDOW = 5
GAMMA = 1.02
REACH = 3.0
#: documents that the wider sketch counts for: a cell's quartiles lean on its language's, and those on the
#: corpus's, the more the fewer documents it has
PRIOR = 200
#: metric: (expression, least spread that counts, whether low values are judged too)
METRICS = {
    "word_length": ("word_chars / n_words", 1.0, True),
    "symbols": ("n_symbols / n_words", 0.1, False),
    "dup_lines": ("n_dup_lines / n_lines", 0.1, False),
    "repeats": ("n_repeat_words / n_words", 0.05, False),
}
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _per_doc(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def block_features(block: tk.Block) -> dict[str, np.ndarray]:
    """Counts of each document of a block."""
    w = tk.words(block)
    n_words = np.diff(w.first)
    heads = (block.data & 0xC0) != 0x80  # first bytes of code points
    chars = _per_doc(heads & ~tk.IS_SPACE[block.data], block.bounds)
    symbols = _per_doc(_SYMBOL[block.data], block.bounds)
    # words inside windows that occur twice or more in their document
    h, at = tk.windows(w, WINDOW)
    doc = w.doc[at]
    order = np.lexsort((h, doc))
    same = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    twice = np.zeros(len(h), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(w.hash) + 1, dtype=np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    repeats = _per_doc(np.cumsum(cover[:-1]) > 0, w.first)
    # lines: borders are line breaks and document borders; a line with a word is compared as a whole
    data, n = block.data, len(block.data)
    breaks = np.flatnonzero(data == 0x0A)
    start = np.union1d(block.bounds[:-1][np.diff(block.bounds) > 0], breaks + 1)
    start = start[start < n]
    line_doc = np.searchsorted(block.bounds, start, "right") - 1
    stop = np.append(start[1:], n)
    stop = stop - ((stop > start) & (data[np.maximum(stop, 1) - 1] == 0x0A)) if len(start) else stop
    worded = np.searchsorted(w.start, stop) > np.searchsorted(w.start, start)
    lines = np.bincount(line_doc[worded], minlength=block.size)
    # of equal lines of a document all but the first
    where, (code, _) = line_doc[worded], tk.coded(data, start[worded], stop[worded])
    order = np.lexsort((code, where))
    again = (code[order][1:] == code[order][:-1]) & (where[order][1:] == where[order][:-1])
    dup = np.bincount(where[order][1:][again], minlength=block.size)
    return {"n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeats, "n_lines": lines}


def features(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang", "source"), names: tuple[str, ...] = FEATURES) -> DataFrame:
    """``keep`` columns and the counts in FEATURES, under ``names``, for every row; a null text counts as empty."""

    @tk.tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tk.blocks(batch.column(batch.num_columns - 1)):
                found = block_features(block)
                same = [c.slice(block.first, block.size) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*same, *(pa.array(found[n].astype(np.int64)) for n in FEATURES)], names=[*batch.schema.names[:-1], *names])

    return mapped(docs, keep, F.col("text"), run, dict.fromkeys(names, "bigint"))


def _bucket(value: Column) -> Column:
    """Bucket of a value; 0 has a bucket of its own below all."""
    return F.when(value > 0, F.ceil(F.log(value) / math.log(GAMMA)).cast("int"))


def _quartiles(counts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, metric, n, q1, q3) of sketches (keys, metric, bucket, n)."""
    by = Window.partitionBy(*keys, "metric")
    upto = by.orderBy(F.col("bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    value = F.when(F.col("bucket").isNull(), 0.0).otherwise(2 * F.pow(F.lit(GAMMA), F.col("bucket")) / (GAMMA + 1))
    ranked = counts.select(*keys, "metric", value.alias("value"), F.sum("n").over(upto).alias("upto"), F.sum("n").over(by).alias("total"))

    def at(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= q * F.col("total"), F.col("value")))

    return ranked.groupBy(*keys, "metric").agg(F.max("total").alias("n"), at(0.25).alias("q1"), at(0.75).alias("q3"))


def thresholds(measured: DataFrame, prior: int = PRIOR) -> DataFrame:
    """(lang, source, and low and high of each metric) of every cell of ``measured`` (lang, source, metrics).

    Quartiles are means of the cell's own and its language's (itself so blended with the
    corpus's), weighted by the cell's documents and ``prior``; with a prior of 0 they are
    the cell's own.
    """
    cells = materialise(
        measured.select("lang", "source", F.explode(F.create_map(*(x for m in METRICS for x in (F.lit(m), F.col(m))))).alias("metric", "value"))
        .groupBy("lang", "source", "metric", _bucket(F.col("value")).alias("bucket"))
        .agg(F.count("*").alias("n")),
        "sketches",
    )
    langs = cells.groupBy("lang", "metric", "bucket").agg(F.sum("n").alias("n"))
    corpus = langs.groupBy("metric", "bucket").agg(F.sum("n").alias("n"))
    own, lang, all_ = _quartiles(cells, ["lang", "source"]), _quartiles(langs, ["lang"]), _quartiles(corpus, [])

    def named(df: DataFrame, mark: str) -> DataFrame:
        return df.select(*(c for c in df.columns if c in ("lang", "source", "metric")), F.struct("n", "q1", "q3").alias(mark))

    joined = named(own, "own").join(named(lang, "of_lang"), ["lang", "metric"]).join(named(all_, "of_all"), "metric")

    def blended(q: str) -> Column:
        lang = (F.col("of_lang.n") * F.col(f"of_lang.{q}") + prior * F.col(f"of_all.{q}")) / (F.col("of_lang.n") + prior)
        return ((F.col("own.n") * F.col(f"own.{q}") + prior * lang) / (F.col("own.n") + prior)).alias(q)

    picked = joined.select("lang", "source", "metric", F.struct(blended("q1"), blended("q3")).alias("q"))
    spread = {m: F.greatest(F.col("q.q3") - F.col("q.q1"), F.lit(least)) for m, (_, least, _) in METRICS.items()}
    fences = []
    for m, (_, _, both) in METRICS.items():
        here = F.col("metric") == m
        fences.append(F.max(F.when(here, F.col("q.q3") + REACH * spread[m])).alias(f"{m}_high"))
        if both:
            fences.append(F.max(F.when(here, F.col("q.q1") - REACH * spread[m])).alias(f"{m}_low"))
    return picked.groupBy("lang", "source").agg(*fences)


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept for every row of ``docs`` (doc_id, text, lang, source).

    base_failed: fewer than ten words, or over a fifth of them in repeated five-word
    windows.  The rest is kept unless a metric lies beyond the fence of its (lang, source);
    null lang and source are cells of their own.  Rows that fail the base rules don't
    enter the sketches.  A null or empty text has no words and fails; texts of any length
    are counted whole.  Repeated rows are judged, and count in the sketches, one by one.
    A value on a fence is kept.  Other columns of ``docs`` are not read.
    """
    found = features(docs.select("doc_id", "text", "lang", "source"))
    found = found.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ("lang", "source")})
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    found = materialise(found.withColumn("base_failed", failed), "features")
    measured = found.where("not base_failed").select("*", *(F.expr(e).alias(m) for m, (e, _, _) in METRICS.items()))
    fences = materialise(thresholds(measured), "fences")
    judged = found.join(fences, ["lang", "source"], "left")
    beyond = []
    for m, (e, _, both) in METRICS.items():
        value = F.when(~F.col("base_failed"), F.expr(e.replace("/ n_words", "/ nullif(n_words, 0)").replace("/ n_lines", "/ nullif(n_lines, 0)")))
        beyond.append(value > F.col(f"{m}_high"))
        if both:
            beyond.append(value < F.col(f"{m}_low"))
    over = F.coalesce(reduce(lambda a, b: a | b, beyond), F.lit(False))
    return judged.select("doc_id", *FEATURES[:5], "base_failed", (~F.col("base_failed") & ~over).alias("kept"))
