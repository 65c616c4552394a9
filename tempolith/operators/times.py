"""Expressions of time to ISO forms and intervals, each distinct one read once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.iso import is_present, week_date
from ..functions.text import let
from ..functions.timegrammar import reading_of
from ..functions.timenorm import normalize

_DAYS_OF = "struct<begin:date,end:date>"


def interval(iso: Column, anchor: Column) -> Column:
    """struct(begin, end) of the days of an ISO point, both inclusive; null for periods and what is none."""
    part = lambda i: F.regexp_extract(iso, r"^([0-9]{4})(?:-(?:W([0-9]{2})|([0-9]{2})(?:-([0-9]{2}))?))?(?:T.*)?$", i)
    year, week, month, day = (part(i).try_cast("int") for i in (1, 2, 3, 4))
    whole = F.format_string("%04d-%02d-%02d", year, F.coalesce(month, F.lit(1)), F.coalesce(day, F.lit(1)))
    begin = F.when(year.isNull(), F.lit(None).cast("date")).when(week.isNotNull(), week_date(year, week)).otherwise(F.try_to_date(whole, "yyyy-MM-dd"))

    def ended(b: Column) -> Column:
        last = F.make_date(year, F.lit(12), F.lit(31))
        end = F.when(week.isNotNull(), F.least(F.date_add(b, 6), last)).when(day.isNotNull(), b).when(month.isNotNull(), F.last_day(b)).otherwise(last)
        return F.struct(b.alias("begin"), end.alias("end"))

    return F.when(is_present(iso), F.struct(anchor.alias("begin"), anchor.alias("end"))).otherwise(let(begin, lambda b: F.when(b.isNotNull(), ended(b))))


def _once(value: Column) -> Column:
    """``value`` as a column that the optimizer neither copies into what uses it nor reasons about: it is large."""
    return F.when(F.rand(0) >= 0, value)


def read_times(expressions: DataFrame, text: str = "covered_text", anchor: str = "doc_date", keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """``expressions`` (text, anchor), distinct, with iso, first_day, last_day, time_kind, about and readings.

    The closed forms of ``normalize`` come first; what they leave goes to the grammar.  Each
    distinct text and date is read once.  iso is empty and readings 0 for what neither reads, null and blank texts among it.  An interval that is
    open on one side has no day there.
    """
    plain = expressions.select(F.col(text).alias("text"), F.col(anchor).alias("anchor")).distinct()
    closed = plain.withColumn("iso", normalize(F.col("text"), F.col("anchor")))
    left = (F.col("iso") == "") & (F.trim("text") != "")
    if keep is not None:
        closed = keep(closed, "times")
        if closed.where(left).isEmpty():
            none = F.lit(None).cast("struct<iso:string,begin:date,end:date,kind:string,about:boolean,readings:int>")
            return _told(closed.withColumn("r", none), text, anchor)
    chart, against = reading_of("text", "anchor")
    charted = closed.withColumn("found", _once(F.when(left, chart)))
    # cached: what stands above reads it several times, and the grammar is planned once for all of it
    return _told(charted.withColumn("r", _once(F.when(F.col("found").isNotNull(), against))), text, anchor).persist()


def _told(read: DataFrame, text: str, anchor: str) -> DataFrame:
    """Results of the closed forms, else of the grammar (``r``)."""
    joined = read.withColumn("days", F.when(F.col("iso") != "", interval(F.col("iso"), F.col("anchor"))))
    done = F.col("iso") != ""
    kind = F.when(F.col("iso").startswith("P") & ~is_present(F.col("iso")), "duration").otherwise("point")
    return joined.select(
        F.col("text").alias(text),
        F.col("anchor").alias(anchor),
        F.when(done, F.col("iso")).otherwise(F.coalesce("r.iso", F.lit(""))).alias("iso"),
        F.when(done, F.col("days.begin")).otherwise(F.col("r.begin")).alias("first_day"),
        F.when(done, F.col("days.end")).otherwise(F.col("r.end")).alias("last_day"),
        F.when(done, kind).otherwise(F.col("r.kind")).alias("time_kind"),
        F.when(done, F.lit(False)).otherwise(F.coalesce("r.about", F.lit(False))).alias("about"),
        F.when(done, 1).otherwise(F.coalesce("r.readings", F.lit(0))).alias("readings"),
    )
