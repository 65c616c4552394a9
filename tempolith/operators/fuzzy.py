"""Near mentions of quotes as a join on q-grams, with only surviving windows compared.

The same mentions as ``align.spans`` finds text by text: the exact ones first, then near ones
behind them, each behind the one before.  Exact ones and the places of windows are Column
expressions.  A window that is near enough must share a number of q-grams with its quote,
which follows from the threshold: each character of the quote without a partner breaks at
most q of its grams, each stretch put in between breaks q - 1.  A gram that is kept stands no
further back in the quote than in the window by more than the quote's characters without a
partner, nor further ahead by more than the window's.  Grams of quotes and of the
parts of sections where windows stand meet in an equi-join by section and gram; windows that
share too few are gone before Python sees them, and of the others it sees their own text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import EXACT, FUZZY
from .align import Matching, _common_bound, compared, exact_spans, literal, near_behind

GRAM = 3
#: near mentions of one quote in one section that are found by joins; what lies behind is searched text by text
ROUNDS = 2


def _grams(text: Column) -> Column:
    """The grams of a text, in the order of their places; none for a shorter text."""
    # one pass: a match takes one character and looks at those behind it
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{GRAM}}}))."), F.lit(1))


def _least_matched(q: Column, w: Column, how: Matching) -> Column:
    return F.ceil(how.threshold * (q + w) / 2 - 1e-9)


def _stepped(open_: DataFrame, how: Matching) -> DataFrame:
    """``open_`` with step, first and last of the windows whose length may do; rows without any go."""
    q, behind = F.col("q"), F.col("n") - F.col("rest")
    step = F.greatest(F.lit(how.min_step), F.floor(q / how.step_fraction))
    longest = F.floor(q * (2 - how.threshold) / how.threshold + 1e-9)
    first = F.when(q + how.padding <= longest, 0).otherwise(F.greatest(F.lit(0), F.ceil((behind - longest) / step)))
    last = F.floor((F.greatest(F.lit(1), behind - q + 1) - 1) / step)
    some = open_.withColumns({"step": step.cast("int"), "first": first.cast("int"), "last": last.cast("int")}).where("first <= last")
    return some


def _able(open_: DataFrame, how: Matching) -> DataFrame:
    """Quotes that have a window at all."""
    return _stepped(open_, how).drop("step", "first", "last")


def windows(open_: DataFrame, ids: list[str], how: Matching) -> DataFrame:
    """(ids, k, step, start, size, least): the windows that a quote's length allows behind ``rest``, and the grams they must share.

    ``open_`` has ids, q (the quote's length), n (the section's) and rest.
    """
    each = _stepped(open_, how).select(*ids, "q", "n", "rest", "step", F.explode(F.sequence("first", "last")).alias("k"))
    return _placed(each, how).select(*ids, "k", "step", "start", "size", "least")


def _placed(each: DataFrame, how: Matching) -> DataFrame:
    """``each`` (q, n, rest, step, k) with start, size and least of its windows; those whose length doesn't do go."""
    q, size = F.col("q"), F.col("size")
    placed = each.withColumn("start", F.col("rest") + F.col("k") * F.col("step"))
    placed = placed.withColumn("size", F.least(F.col("n") - F.col("start"), q + how.padding).cast("int"))
    matched = _least_matched(q, size, how)
    least = (q - GRAM + 1) - GRAM * (q - matched) - (GRAM - 1) * (size - matched)
    return placed.where(2 * F.least("q", "size") >= how.threshold * (q + size)).withColumn("least", least.cast("int"))


def _met(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """An inner join by sorted parts.

    A small file may stand for many rows, of texts that come again or of the grams or windows made from
    them; Spark's planner goes by the file and would gather and send out such a side by way of the driver.
    """
    return left.hint("merge").join(right, on)


def candidates(open_: DataFrame, sections: DataFrame, keys: list[str], own: list[str], how: Matching) -> DataFrame:
    """(keys, own, k, start, size) of the windows that share enough grams with their quote.

    ``open_`` (keys, own, quote, q, n, rest) are the quotes still to be searched for, ``sections`` (keys, text) where.
    """
    ids, q = [*keys, *own], F.col("q")
    stepped = _stepped(open_, how)
    # only the parts of sections in which windows stand are cut into grams
    upto = F.least(F.col("n"), F.col("rest") + F.col("last") * F.col("step") + q + how.padding)
    region = stepped.groupBy(*keys).agg(F.min(F.col("rest") + F.col("first") * F.col("step")).alias("low"), F.max(upto).alias("high"))
    part = _met(sections.select(*keys, "text"), region, keys)
    there = part.select(*keys, "low", F.posexplode(_grams(F.substring(F.col("text"), F.col("low") + 1, F.col("high") - F.col("low")))).alias("i", "gram"))
    there = there.select(*keys, (F.col("low") + F.col("i")).alias("at"), "gram")
    grams = open_.select(*ids, "q", "n", "rest", F.posexplode(_grams(F.col("quote"))).alias("i", "gram"))
    wanted = grams.groupBy(*ids, "q", "n", "rest", "gram").agg(F.count("*").alias("wanted"), F.min("i").alias("head"), F.max("i").alias("tail"))
    hits = _stepped(_met(wanted, there, [*keys, "gram"]), how)
    # a place lies in a few windows, whose numbers follow from it and from the gram's places in the quote
    at, step = F.col("at") - F.col("rest"), F.col("step")
    alone = q - F.ceil(q * how.threshold / (2 - how.threshold) - 1e-9)  # the shortest window that may do leaves most of the quote without a partner
    spare = q + how.padding - _least_matched(q, q + how.padding, how)  # the longest one has most characters to spare
    high = F.least(F.col("last"), F.floor(F.least(at, at - F.col("head") + alone) / step))
    low = F.greatest(F.col("first"), F.ceil(F.greatest(at + GRAM - q - how.padding, at - F.col("tail") - spare) / step))
    each = hits.withColumns({"low": low.cast("int"), "high": high.cast("int")}).where("low <= high")
    each = each.select(*ids, "q", "n", "rest", "step", "gram", "wanted", "head", "tail", "at", F.explode(F.sequence("low", "high")).alias("k"))
    inside = _placed(each, how).where((F.col("least") > 0) & (F.col("at") + GRAM <= F.col("start") + F.col("size")))
    matched, shift = _least_matched(q, F.col("size"), how), F.col("at") - F.col("start")
    inside = inside.where((shift - F.col("tail") <= F.col("size") - matched) & (shift - F.col("head") >= matched - q))
    counted = inside.groupBy(*ids, "k", "start", "size", "least", "gram").agg(F.least(F.count("*"), F.max("wanted")).alias("shared"))
    enough = counted.groupBy(*ids, "k", "start", "size", "least").agg(F.sum("shared").alias("shared")).where("shared >= least")
    few = windows(open_, ids, how).where("least <= 0")  # a bound that says nothing: short quotes, at the end of their sections only
    return enough.select(*ids, "k", "start", "size").union(few.select(*ids, "k", "start", "size"))


def scored(windows: DataFrame, ids: list[str], how: Matching) -> DataFrame:
    """(ids, start, begin, score) of the windows (ids, start, quote, window) that are near enough.

    begin is where the quote would begin, told by the longest common block, from the window's start.
    """
    source = windows.select(*ids, "start", "quote", "window")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[: len(ids)]), "start int", "begin int", "score double"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for quote, window in zip(frame["quote"], frame["window"], strict=True):
                total = len(quote) + len(window)
                if 2 * _common_bound(quote, window) < how.threshold * total:
                    found.append((0, -1.0))
                    continue
                score, shift = compared(quote, window)
                told = not how.whole or 0 <= shift <= len(window) - len(quote)
                found.append((shift, score if told else -1.0))
            out = frame[[*ids, "start"]].assign(begin=[b for b, _ in found], score=[s for _, s in found])
            yield out[out["score"] >= how.threshold]

    return source.mapInPandas(run, schema)


def _behind(open_: DataFrame, ids: list[str], how: Matching) -> DataFrame:
    """Near mentions behind ``rest`` of ``open_`` (ids, quote, text, rest), one text after the other."""
    source = open_.select(*ids, "quote", "text", "rest")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[: len(ids)]), "begin int, end int, score double"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for key, quote, text, rest in zip(frame[ids].itertuples(index=False), frame["quote"], frame["text"], frame["rest"], strict=True):
                rows += [(*key, *found) for found in near_behind(text, quote, rest, how)]
            yield pd.DataFrame(rows, columns=[*ids, "begin", "end", "score"])

    return source.mapInPandas(run, schema)


def near_spans(
    pairs: DataFrame,
    sections: DataFrame,
    keys: list[str],
    own: list[str],
    how: Matching = Matching(),
    rounds: int | None = None,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """(keys, own, begin, end, score, status) of all mentions of quotes in the section of their keys.

    ``pairs`` has keys, own and quote, keys and own naming one row; ``sections`` has keys and
    text, keys naming one.  Null and empty quotes and texts have none.  ``keep`` stores the tables
    that the next round reads several times; without it a plan of several rounds is long, so
    there are none then unless ``rounds`` says so: quotes that a window's length allows at all
    go on text by text.  With ``how.whole`` one round finds all places.
    """
    rounds = (ROUNDS if keep else 0) if rounds is None else rounds
    names, sections = [*keys, *own], sections.select(*(F.col(c).alias(f"key{i}") for i, c in enumerate(keys)), "text")
    pairs = pairs.select(*(F.col(c).alias(f"key{i}") for i, c in enumerate(keys)), *(F.col(c).alias(f"own{i}") for i, c in enumerate(own)), "quote")
    keys, own = [f"key{i}" for i in range(len(keys))], [f"own{i}" for i in range(len(own))]
    ids = [*keys, *own]
    some = _met(sections.select(*keys, "text"), pairs.select(*ids, "quote").where("quote <> ''"), keys).where("text <> ''")
    exact = exact_spans(some, ids).select(*ids, "begin", "end", F.lit(1.0).alias("score"))
    gaps = F.split("text", literal(F.col("quote")), F.lit(-1))
    last = F.when(F.contains("text", "quote"), F.length("text") - F.length(F.element_at(gaps, -1))).otherwise(0)
    open_ = some.select(*ids, "quote", F.length("quote").alias("q"), F.length("text").alias("n"), last.cast("int").alias("rest"), *([] if rounds else ["text"])).where("rest < n")
    stored = keep is not None
    keep = keep or (lambda table, name: table)
    open_ = keep(_able(open_, how), "open-0") if rounds else open_
    found = [exact]
    for i in range(rounds):
        if stored and open_.isEmpty():  # the usual case: all quotes are short
            break
        left = _met(candidates(open_, sections, keys, own, how), open_.select(*ids, "quote", "rest"), ids)
        cut = _met(left, sections.select(*keys, "text"), keys).select(*ids, "start", "quote", F.substring("text", F.col("start") + 1, F.col("size")).alias("window"))
        near = scored(cut, ids, how)
        if how.whole:  # all places at once, so nothing is left to search behind them
            place = (F.col("start") + F.col("begin")).alias("begin")
            told = _met(near.groupBy(*ids, place).agg(F.max("score").alias("score")), open_.select(*ids, "q"), ids)
            found.append(told.select(*ids, "begin", (F.col("begin") + F.col("q")).alias("end"), "score"))
            break
        best = near.groupBy(*ids).agg(F.max(F.struct("score", (-F.col("start")).alias("first"), "begin")).alias("b"))
        near = _met(best, open_, ids).select(*ids, "quote", "q", "n", F.greatest(F.col("rest"), F.col("b.begin") - F.col("b.first")).alias("begin"), "b.score")
        near = keep(near.withColumn("end", F.col("begin") + F.col("q")), f"near-{i}")
        found.append(near.select(*ids, "begin", "end", "score"))
        open_ = _able(near.select(*ids, "quote", "q", "n", F.col("end").alias("rest")).where("rest < n"), how)
    if not (rounds and how.whole):
        behind = _met(open_, sections.select(*keys, "text"), keys) if rounds else open_
        found.append(_behind(_able(behind, how), ids, how))
    every = exact
    for part in found[1:]:
        every = every.union(part)
    told = every.withColumn("status", F.when(F.col("score") >= how.exact, EXACT).otherwise(FUZZY))
    return told.select(*(F.col(i).alias(c) for i, c in zip(ids, names, strict=True)), "begin", "end", "score", "status")
