"""Sentences by statistics that the corpus itself gives.

A period ends a sentence unless it belongs to an abbreviation.  Which words are
abbreviations is learned without labels: a word type is one if it stands with a period far
more often than words in general do (Dunning's log-likelihood against a period nearly
always), weighed by its length, its inner periods and how often it stands without one.
Words that begin sentences far more often than they stand elsewhere are starters; behind an
abbreviation only such a one, in upper case, begins a new sentence.  Counts are plain
aggregations by word type; texts are not shuffled.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: a type counts as an abbreviation from this score on, as a starter from this log-likelihood on
ABBREVIATION, STARTER = 0.3, 30.0
#: more learned types than this are refused, as the model goes to every task
MAX_TYPES = 1_000_000
_SPACE = r"[\x20\x09-\x0D]+"
_OPEN, _CLOSE = r"""^[("'\[{]+""", r"""[)"'\]}]+$"""


@dataclass(frozen=True)
class Model:
    abbreviations: frozenset[str]
    starters: frozenset[str]


def _bare(word: Column) -> Column:
    """A word without brackets and quotes around it."""
    return F.regexp_replace(F.regexp_replace(word, _OPEN, ""), _CLOSE, "")


def _types(docs: DataFrame) -> DataFrame:
    """(type, dotted, next, upper, n): how often each word stands before which one, whether a period ends it.

    Spellings are counted first, those without a period whatever follows, so that patterns run once for each of them.
    """
    each = docs.select(F.split("text", _SPACE).alias("w")).select(F.inline(F.arrays_zip(F.col("w").alias("word"), F.slice("w", F.lit(2), F.greatest(F.size("w") - 1, F.lit(0))).alias("next"))))
    raw = each.select("word", F.when(F.contains("word", F.lit(".")), F.col("next")).alias("next")).groupBy("word", "next").agg(F.count("*").alias("n"))
    bare = raw.select(_bare(F.col("word")).alias("word"), _bare(F.col("next")).alias("next"), "n")
    dotted = F.col("word").rlike(r"[^.]\.$")
    plain = lambda c: F.lower(F.regexp_replace(c, r"[.,;:!?]+$", ""))
    kind = F.when(dotted, F.lower(F.expr("substring(word, 1, length(word) - 1)"))).otherwise(plain(F.col("word")))
    return bare.select(
        F.when(F.col("n") > 0, kind).alias("type"),  # always so; it keeps filters by type behind the counts
        dotted.alias("dotted"),
        plain(F.col("next")).alias("next"),
        F.col("next").rlike(r"^\p{Lu}").alias("upper"),
        "n",
    ).where("type <> ''")


def abbreviation_scores(docs: DataFrame) -> DataFrame:
    """(type, with_period, alone, score) of every word type of ``docs`` (text) that stands with a period and has a letter.

    Null texts have no words.
    """
    counts = _types(docs).groupBy("type").agg(*(F.sum(F.when(kind, F.col("n")).otherwise(0)).alias(name) for kind, name in ((F.col("dotted"), "with_period"), (~F.col("dotted"), "alone"))))
    total = counts.agg(F.sum("with_period").alias("dots"), F.sum(F.col("with_period") + F.col("alone")).alias("words"))
    k, n = F.col("with_period"), F.col("with_period") + F.col("alone")
    p = F.col("dots") / F.col("words")
    likely = 2 * (k * (F.lit(math.log(0.99)) - F.ln(p)) + (n - k) * (F.lit(math.log(0.01)) - F.ln(1 - p)))
    inner = F.length(F.regexp_replace("type", r"[^.]", ""))
    size = F.length("type") - inner
    weighed = likely * F.exp(-size) * (inner + 1) * F.pow(size.cast("double"), -F.col("alone").cast("double"))
    some = counts.where((F.col("with_period") > 0) & F.col("type").rlike(r"\p{L}"))
    # one row of totals beside each type
    return some.crossJoin(F.broadcast(total)).where("dots < words").select("type", "with_period", "alone", weighed.alias("score"))


def starter_scores(docs: DataFrame, abbreviations: DataFrame) -> DataFrame:
    """(type, after, total, score): how strongly word types draw to the place behind a period that is no abbreviation's."""
    words = _types(docs)
    follows = words.where("dotted and upper and next <> ''").groupBy("type", "next").agg(F.sum("n").alias("n"))
    after = follows.join(abbreviations.select("type"), "type", "left_anti").groupBy(F.col("next").alias("type")).agg(F.sum("n").alias("after"))
    total = words.groupBy("type").agg(F.sum("n").alias("total"))
    sums = total.agg(F.sum("total").alias("words")).crossJoin(F.broadcast(after.agg(F.sum("after").alias("ends"))))
    both = after.join(total, "type").crossJoin(F.broadcast(sums))
    a, t, e, w = (F.col(c).cast("double") for c in ("after", "total", "ends", "words"))

    def part(k: Column, n: Column, p: Column) -> Column:
        """Log-likelihood of k of n, with 0 times the logarithm of 0 as 0."""
        return F.when(k > 0, k * F.ln(p)).otherwise(0) + F.when(n - k > 0, (n - k) * F.ln(1 - p)).otherwise(0)

    rest, elsewhere = w - e, F.greatest(t - a, F.lit(0.0))
    p, p1, p2 = t / w, a / e, elsewhere / rest
    likely = 2 * (part(a, e, p1) + part(elsewhere, rest, p2) - part(a, e, p) - part(elsewhere, rest, p))
    return both.where("words > ends").select("type", "after", "total", F.when(p1 > p2, likely).otherwise(0.0).alias("score"))


def learn(docs: DataFrame) -> Model:
    """The abbreviations and starters of ``docs`` (text): counts over all of them, of which only what passes the scores reaches the driver."""
    short = abbreviation_scores(docs).where(F.col("score") >= ABBREVIATION)
    first = starter_scores(docs, short).where((F.col("score") >= STARTER) & F.col("type").rlike(r"^\p{L}"))
    # one job, in which the counts that both stand on are made once
    kinds = [df.select(F.lit(i).alias("kind"), "type").limit(MAX_TYPES + 1) for i, df in enumerate((short, first))]
    rows = kinds[0].union(kinds[1]).collect()
    found = [frozenset(r["type"] for r in rows if r["kind"] == i) for i in (0, 1)]
    if max(map(len, found)) > MAX_TYPES:
        raise ValueError(f"more than {MAX_TYPES} types; raise the scores")
    return Model(*found)


#: from the beginning of a word, so that a word without a mark is tried once
_END = re.compile(r"""(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]*[.!?][.!?)"'\]}]*(?=[\x20\x09-\x0D]+([^\x20\x09-\x0D]+)|[\x20\x09-\x0D]*\Z)""")
_STRIP_OPEN, _STRIP_CLOSE = re.compile(_OPEN), re.compile(_CLOSE)


def ends(text: str, model: Model) -> list[int]:
    """Where sentences end in a text; the last one ends with the text."""
    out = []
    for m in _END.finditer(text):
        if m[1] is None:
            break
        word = _STRIP_CLOSE.sub("", _STRIP_OPEN.sub("", m[0]))
        dotted = len(word) > 1 and word[-1] == "." and word[-2] != "."
        if dotted and word[:-1].lower() in model.abbreviations:
            follower = _STRIP_CLOSE.sub("", _STRIP_OPEN.sub("", m[1]))
            if not (follower[:1].isupper() and re.sub(r"[.,;:!?]+$", "", follower).lower() in model.starters):
                continue
        out.append(m.end())
    if len(text.rstrip(" \t\n\x0b\f\r")) > (out[-1] if out else 0):
        out.append(len(text))
    return out


def split(docs: DataFrame, keys: tuple[str, ...], model: Model) -> DataFrame:
    """(keys, sentence_id, begin, end, text) of the sentences of ``docs`` (keys, text), without white space around them.

    Decimals and inner periods are no ends, as white space must follow one.  Null and blank texts have none.
    """

    @F.arrow_udf("array<struct<begin:int,end:int,text:string>>")
    def cut(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts.to_pylist():
            at, found = 0, []
            for end in ends(text or "", model):
                part = text[at:end]
                begin = at + len(part) - len(part.lstrip(" \t\n\x0b\f\r"))
                whole = part.strip(" \t\n\x0b\f\r")
                if whole:
                    found.append({"begin": begin, "end": begin + len(whole), "text": whole})
                at = end
            rows.append(found)
        return pa.array(rows, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("text", pa.string())])))

    return docs.select(*keys, F.posexplode(cut("text")).alias("sentence_id", "s")).select(*keys, "sentence_id", "s.begin", "s.end", "s.text")
