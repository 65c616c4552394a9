"""Quotes to character spans: exact everywhere, fuzzy where nothing exact is left."""

from __future__ import annotations

import collections
import functools
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schemas import EXACT, FUZZY, MENTION, NOT_FOUND


@dataclass(frozen=True)
class Matching:
    """How near a quote must be.

    Windows may cut the quote: a shorter one that leaves out a few of its characters can resemble it
    more than one that holds it all.  With ``whole`` only windows count that hold the place they tell from
    its begin to its end, and a near mention is every such place, with the score of its best window.
    """

    threshold: float = 0.85
    exact: float = 0.999
    min_step: int = 8
    step_fraction: int = 4
    padding: int = 64
    whole: bool = False


def first_span(text: Column, quote: Column) -> Column:
    """struct(begin, end, score, status) of the first exact occurrence; nulls and 0 without one."""
    at = F.position(quote, text)
    hit = (F.length(quote) > 0) & (at > 0)
    return F.struct(
        F.when(hit, at - 1).alias("begin"),
        F.when(hit, at - 1 + F.length(quote)).alias("end"),
        F.when(hit, 1.0).otherwise(0.0).alias("score"),
        F.when(hit, EXACT).otherwise(NOT_FOUND).alias("status"),
    )


def literal(quote: Column) -> Column:
    """A pattern that matches a quote as it stands."""
    return F.concat(F.lit("\\Q"), F.replace(quote, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def exact_spans(pairs: DataFrame, keys: list[str], text: str = "text", quote: str = "quote") -> DataFrame:
    """``keys``, n, begin and end of all non-overlapping occurrences, left to right.

    ``keys`` must name one row of ``pairs`` (text, quote).  Null and empty quotes have none.
    """
    some = pairs.where((F.length(quote) > 0) & F.contains(F.col(text), F.col(quote)))
    parts = some.select(*keys, F.length(quote).alias("q"), F.posexplode(F.split(F.col(text), literal(F.col(quote)), F.lit(-1))).alias("n", "gap"))
    upto = Window.partitionBy(*keys).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    last = F.max("n").over(Window.partitionBy(*keys))
    placed = parts.select(*keys, "n", "q", (F.sum(F.length("gap") + F.col("q")).over(upto)).cast("int").alias("end"), last.alias("last"))
    return placed.where("n < last").select(*keys, "n", (F.col("end") - F.col("q")).alias("begin"), "end")


def _common_bound(quote: str, window: str) -> int:
    """Length of the longest common subsequence: no pair of texts has more characters in matching blocks.

    One bit for each character of the quote; a window's character carries through the
    places where it stands, all of them at once.
    """
    places: dict[str, int] = {}
    for i, c in enumerate(quote):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(quote)) - 1
    row = full
    for c in window:
        here = places.get(c, 0)
        row = (row + (row & here) | row & ~here) & full
    return len(quote) - row.bit_count()


def _longest(a: str, alo: int, ahi: int, b: str, blo: int, bhi: int) -> tuple[int, int, int]:
    """(place in a, place in b, size) of the longest common stretch of two parts; of equal ones the first in a, then in b."""
    best, size = (alo, blo), 0
    for i in range(alo, ahi):
        if i + size >= ahi:  # what is left of a is no longer
            break
        j = b.find(a[i : i + size + 1], blo, bhi)
        while j >= 0:
            best, size = (i, j), size + 1
            while i + size < ahi and j + size < bhi and a[i + size] == b[j + size]:
                size += 1
            j = b.find(a[i : i + size + 1], j + 1, bhi) if i + size < ahi else -1
    return (*best, size)


def compared(quote: str, window: str) -> tuple[float, int]:
    """Share of the characters of both in common blocks, and where the quote would begin in the window by the longest one.

    The blocks are those of ``difflib.SequenceMatcher`` without junk: the longest common one,
    then the longest ones on its left and on its right, and so on.
    """
    total = len(quote) + len(window)
    if not total:
        return 1.0, 0
    first = _longest(quote, 0, len(quote), window, 0, len(window))
    matched, open_ = 0, [(0, len(quote), 0, len(window), first)]
    while open_:
        alo, ahi, blo, bhi, (i, j, size) = open_.pop()
        matched += size
        if size:
            for part in ((alo, i, blo, j), (i + size, ahi, j + size, bhi)):
                if part[0] < part[1] and part[2] < part[3]:
                    open_.append((*part, _longest(quote, part[0], part[1], window, part[2], part[3])))
    return 2.0 * matched / total, first[1] - first[0]


def _bounded(text: str, quote: str, how: Matching) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and sizes of the windows whose length may do, and bounds of their scores by the characters they share with the quote."""
    q, n = len(quote), len(text)
    starts = np.arange(0, max(1, n - q + 1), max(how.min_step, q // how.step_fraction))
    sizes = np.minimum(n - starts, q + how.padding)
    able = 2 * np.minimum(q, sizes) >= how.threshold * (q + sizes)
    starts, sizes = starts[able], sizes[able]
    shared = np.zeros(len(starts), np.int64)
    if len(starts):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        for c, wanted in collections.Counter(quote).items():
            seen = np.concatenate([[0], np.cumsum(codes == ord(c))])
            shared += np.minimum(wanted, seen[starts + sizes] - seen[starts])
    return starts, sizes, 2 * shared / (q + sizes)


def nearest(text: str, quote: str, how: Matching = Matching()) -> tuple[int, float] | None:
    """Begin and score of the stretch of a text that resembles a quote most, if it is near enough.

    Windows of the quote's length and some padding stand at regular places; the score of
    one is the share of its and the quote's characters in common blocks, and the longest
    common block says where the quote would begin.  Of equal scores the first window's
    counts.  Each window has upper bounds of its score, by its length, by the characters
    it shares with the quote and by their order; only windows that can still win are
    compared block by block, the most promising first.
    """
    q = len(quote)
    starts, sizes, bound = _bounded(text, quote, how)
    best: tuple[float, int, int] | None = None
    for k in np.lexsort((starts, -bound)):
        if bound[k] < how.threshold or (best and bound[k] < best[0]):
            break
        begin = int(starts[k])
        window = text[begin : begin + int(sizes[k])]
        most = 2 * _common_bound(quote, window) / (q + len(window))
        if most < how.threshold or (best and (most, -begin) < best[:2]):
            continue
        score, shift = compared(quote, window)
        if score >= how.threshold and (best is None or (score, -begin) > best[:2]):
            best = score, -begin, max(0, begin + shift)
    return (best[2], best[0]) if best else None


def places(text: str, quote: str, how: Matching) -> list[tuple[int, float]]:
    """Begin and score of all places that near enough windows hold whole, left to right, each with its best window's score."""
    found: dict[int, float] = {}
    for begin, size, bound in zip(*(x.tolist() for x in _bounded(text, quote, how)), strict=True):
        window = text[begin : begin + size]
        if min(bound, 2 * _common_bound(quote, window) / (len(quote) + size)) >= how.threshold:
            score, shift = compared(quote, window)
            if score >= how.threshold and 0 <= shift <= size - len(quote):
                found[begin + shift] = max(score, found.get(begin + shift, 0.0))
    return sorted(found.items())


def near_behind(text: str, quote: str, rest: int, how: Matching) -> list[tuple[int, int, float]]:
    """(begin, end, score) of the near mentions behind ``rest``: each behind the one before, or all places that windows hold whole."""
    size = len(quote)
    if how.whole:
        return [(rest + begin, rest + begin + size, score) for begin, score in places(text[rest:], quote, how)] if rest < len(text) else []
    found = []
    while rest < len(text) and (near := nearest(text[rest:], quote, how)):
        begin, score = rest + near[0], near[1]
        rest = begin + size
        found.append((begin, rest, score))
    return found


def spans(text: str | None, quote: str | None, how: Matching = Matching()) -> list[tuple[int, int, float, str]]:
    """All mentions of a quote in a text: (begin, end, score, status), left to right.

    The exact ones first, none overlapping; what is left behind the last is then searched
    for near ones, each behind the one before, as long as there are any (for all at once with ``how.whole``).
    """
    if not text or not quote:
        return []
    size = len(quote)
    found, at = [], text.find(quote)
    while at >= 0:
        found.append((at, at + size, 1.0, EXACT))
        at = text.find(quote, at + size)
    rest = found[-1][1] if found else 0
    return found + [(begin, end, score, EXACT if score >= how.exact else FUZZY) for begin, end, score in near_behind(text, quote, rest, how)]


def align(pairs: DataFrame, how: Matching = Matching(), text: str = "text", quote: str = "quote") -> DataFrame:
    """``pairs`` with ``mentions``: array of struct(begin, end, score, status).

    Python sees only the pairs, so make them distinct first.  They are dealt out before, in a
    fixed number of parts, as few bytes may stand for much work.
    """
    names = [c for c in pairs.columns if c != "mentions"]
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = pairs.select(*names).repartition(parts, text, quote)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields) + f", mentions {MENTION}"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [[dict(zip(("begin", "end", "score", "status"), s, strict=True)) for s in spans(t, q, how)] for t, q in zip(frame[text], frame[quote], strict=True)]
            yield frame.assign(mentions=found)

    return source.mapInPandas(run, schema)


def mentions(tlinks: DataFrame, sections: DataFrame, how: Matching | None = Matching(), keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Mentions of every text of the triplets in its own section.

    (doc key, section_id, kind, concept_text, begin, end, covered_text, confidence, status)
    with offsets in the document.  ``how=None`` looks for exact ones only.  Exact mentions stay
    in the JVM either way; of near ones Python sees the windows that ``fuzzy`` lets pass.
    """
    from . import fuzzy  # it builds on this module

    keys = ["patient_id", "doc_id", "section_id"]
    texts = tlinks.select(*keys, F.explode(F.array(F.struct(F.lit("MED").alias("kind"), F.col("sact").alias("quote")), F.struct(F.lit("TIME").alias("kind"), F.col("time").alias("quote")))).alias("q"))
    own = ["kind", "quote"]
    pairs = texts.select(*keys, F.col("q.kind"), F.col("q.quote")).where("quote <> ''").distinct()
    if how is None:
        found = exact_spans(pairs.join(sections.select(*keys, "text"), keys), [*keys, *own])
        found = found.withColumns({"score": F.lit(1.0), "status": F.lit(EXACT)})
    else:
        found = fuzzy.near_spans(pairs.withColumn("concept", F.col("quote")), sections, keys, ["kind", "concept"], how, keep=keep).withColumnRenamed("concept", "quote")
    found = found.join(sections.select(*keys, F.col("begin").alias("base"), "text"), keys)
    return found.select(
        *keys,
        "kind",
        F.col("quote").alias("concept_text"),
        (F.col("base") + F.col("begin")).alias("begin"),
        (F.col("base") + F.col("end")).alias("end"),
        F.substring("text", F.col("begin") + 1, F.col("end") - F.col("begin")).alias("covered_text"),
        F.col("score").alias("confidence"),
        "status",
    )


def contained(docs: DataFrame, quotes: DataFrame, doc: str = "doc_id", item: str = "item_id", max_bytes: int = 32 << 20) -> DataFrame:
    """(doc, item, begin, end) of the first occurrence of every quote in every text that holds it.

    A containment join in one pass: an automaton of the quotes, built once in each Python
    worker, runs over every text.  Quotes go out in blocks of at most about ``max_bytes``,
    each a broadcast of its own.  Null and empty quotes are in nothing.
    """
    some = quotes.select(item, "text").where("text <> ''")
    blocks = max(1, -(-(some.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // max_bytes))
    kinds = [x.schema[c].dataType.simpleString() for x, c in ((docs, doc), (quotes, item))]
    schema = f"`{doc}` {kinds[0]}, `{item}` {kinds[1]}, begin int, end int"
    source = docs.select(doc, "text").where("text is not null")
    parts = []
    for i in range(blocks):
        rows = [tuple(r) for r in some.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == i).collect()]
        sent = docs.sparkSession.sparkContext.broadcast(rows)
        token = uuid.uuid4().hex

        def run(frames: Iterator[pd.DataFrame], sent: Broadcast = sent, token: str = token) -> Iterator[pd.DataFrame]:
            machine = _automaton(token, sent)
            for frame in frames:
                found = []
                for key, text in zip(frame[doc], frame["text"], strict=True):
                    seen = set()
                    for last, (n, keys) in machine.iter(text) if machine else ():
                        if keys[0] not in seen:
                            seen.add(keys[0])
                            found += [(key, k, last + 1 - n, last + 1) for k in keys]
                yield pd.DataFrame(found, columns=[doc, item, "begin", "end"])

        parts.append(source.mapInPandas(run, schema))
    return functools.reduce(DataFrame.union, parts)


_machines: dict[str, object] = {}


def _automaton(token: str, sent: Broadcast):
    """The automaton of a block of (item, text); a Python worker keeps the last one only."""
    import ahocorasick

    if token not in _machines:
        items: dict[str, list] = {}
        for key, text in sent.value:
            items.setdefault(text, []).append(key)
        machine = ahocorasick.Automaton()
        for text, keys in items.items():
            machine.add_word(text, (len(text), keys))
        if items:
            machine.make_automaton()
        _machines.clear()
        _machines[token] = machine if items else None
    return _machines[token]
