"""Header metadata of a note: document time, type and institution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DATE_LINE, DOC, TYPE_LINE


def doc_time_text(text: Column) -> Column:
    """Digits of the first date line, noon for a date without time; empty without one."""
    digits = F.concat(F.regexp_extract(text, DATE_LINE, 1), F.replace(F.regexp_extract(text, DATE_LINE, 2), F.lit(" "), F.lit("")))
    return F.when(F.length(digits) == 8, F.concat(digits, F.lit("1200"))).otherwise(digits)


def parse_doc_time(digits: Column) -> Column:
    """Timestamp of yyyyMMddHHmm, hours 1 to 24 as the headers have them; null for anything else."""
    fixed = F.when(F.substring(digits, 9, 2) == "24", F.concat(F.substring(digits, 1, 8), F.lit("00"), F.substring(digits, 11, 2))).otherwise(digits)
    return F.when(F.length(digits) == 12, F.try_to_timestamp(fixed, F.lit("yyyyMMddHHmm")))


def doc_type(text: Column) -> Column:
    return F.regexp_extract(text, TYPE_LINE, 1)


def source_date(ts: Column) -> Column:
    """MMddyyyyHHmmss with midnight as hour 24."""
    hour = F.when(F.hour(ts) == 0, "24").otherwise(F.date_format(ts, "HH"))
    return F.concat(F.date_format(ts, "MMddyyyy"), hour, F.date_format(ts, "mmss"))


def doc_meta(sections: DataFrame, institution: str | None = None) -> DataFrame:
    """(doc key, institution, doc_ts, doc_date, doc_type): the first section that has a value gives it."""
    told = sections.select(*DOC, "section_id", parse_doc_time(doc_time_text(F.col("text"))).alias("ts"), doc_type(F.col("text")).alias("type"))
    first = F.min_by(F.col("ts"), F.when(F.col("ts").isNotNull(), F.col("section_id")))
    kind = F.min_by(F.col("type"), F.when(F.trim("type") != "", F.col("section_id")))
    meta = told.groupBy(*DOC).agg(first.alias("doc_ts"), F.coalesce(kind, F.lit("")).alias("doc_type"))
    return meta.select(*DOC, F.lit(institution).cast("string").alias("institution"), "doc_ts", F.to_date("doc_ts").alias("doc_date"), "doc_type")


def anchor(meta: DataFrame, notes: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Document times with fallbacks: the header's, else the file's, else ``as_of`` (today)."""
    files = notes.select(*DOC, F.col("mtime"))
    ts = F.coalesce("doc_ts", "mtime", as_of.cast("timestamp") if as_of is not None else F.current_date().cast("timestamp"))
    return meta.join(files, list(DOC), "left").withColumn("doc_ts", ts).withColumn("doc_date", F.to_date("doc_ts")).drop("mtime")
