"""Rows of the per-document tables, in the order in which they are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import snippet
from ..schemas import DOC, DURATION, FAILED, INSTANT

KIND = "-- SACT --"
ROW7 = ("kind", "med", "relation", "time_type", "iso", "time_normal", "timex")
ROW9 = ("med_normal", "med_text", "med_span", "relation", "time_normal", "timex", "timex_span", "time_type", "iso")
ROW6 = ("med", "relation", "iso", "time_normal", "timex", "snippet")


def _class_order(time_type: Column) -> Column:
    return F.when(time_type == INSTANT, 0).when(time_type == FAILED, 1).when(time_type == DURATION, 2).otherwise(3)


def _span(begin: Column, end: Column) -> Column:
    return F.concat_ws(",", begin.cast("string"), end.cast("string"))


def table_rows(normals: DataFrame) -> DataFrame:
    """Seven columns for each relation and distinct normalized time, with ``sort_key``."""
    order = F.struct("med_text", "category", "tlink_id", _class_order(F.col("time_type")).alias("c"), "time_normal", "timex_span")
    return normals.select(
        *DOC,
        order.alias("sort_key"),
        F.lit(KIND).alias("kind"),
        F.col("med_text").alias("med"),
        F.col("category").alias("relation"),
        "time_type",
        "iso",
        "time_normal",
        "timex",
    )


def span_rows(normals: DataFrame, mentions: DataFrame) -> DataFrame:
    """Nine columns for each mention of the event and of the time, each row once.

    What would repeat a row goes from both sides before the join, so that nothing is gathered
    behind it: of a row's sort keys the least has the least tlink_id and the least span.  One
    shuffle by the keys of the join and one sort of each side, where they come first, serve all.
    """
    first = lambda table, of, order: table.withColumn("n", F.row_number().over(Window.partitionBy(*of).orderBy(*order))).where("n = 1").drop("n")
    keys = [*DOC, "med_text"]
    of_time = ["category", "time_normal", "timex", "timex_span", "time_type", "iso"]
    edges = first(normals.select(*keys, *of_time, "tlink_id").repartition(*keys), [*keys, *of_time], ["tlink_id"])
    meds = mentions.where("kind = 'MED'").select(*DOC, F.col("concept_text").alias("med_text"), F.col("begin").alias("b"), F.col("end").alias("e"), F.col("covered_text").alias("covered"))
    meds = first(meds.withColumn("span", _span(F.col("b"), F.col("e"))).repartition(*keys), [*keys, "covered", "span"], ["b", "e"])
    rows = edges.join(meds, keys)
    return rows.select(
        *DOC,
        F.struct("med_text", "category", "tlink_id", "b", "e", _class_order(F.col("time_type")).alias("c"), "time_normal", "timex_span").alias("sort_key"),
        F.col("med_text").alias("med_normal"),
        F.col("covered").alias("med_text"),
        F.col("span").alias("med_span"),
        F.col("category").alias("relation"),
        "time_normal",
        "timex",
        "timex_span",
        "time_type",
        "iso",
    )


def mention_rows(normals: DataFrame, mentions: DataFrame, notes: DataFrame) -> DataFrame:
    """Six columns: a head row for each normalized time, then a row with a snippet for each pair of mentions."""
    order = lambda kind, begin, end: F.struct("med_text", "category", "tlink_id", "time_normal", "timex_span", F.lit(kind).alias("detail"), begin.alias("b"), end.alias("t"))
    zero = F.lit(0)
    heads = normals.select(*DOC, order(0, zero, zero).alias("sort_key"), F.col("med_text").alias("med"), F.col("category").alias("relation"), "iso", "time_normal", "timex", F.lit("").alias("snippet"))
    of = lambda kind, text, p: mentions.where(F.col("kind") == kind).select(*DOC, F.col("concept_text").alias(text), F.col("begin").alias(f"{p}b"), F.col("end").alias(f"{p}e"), F.col("covered_text").alias(f"{p}t"))
    pairs = normals.join(of("MED", "med_text", "m"), [*DOC, "med_text"]).join(of("TIME", "time_text", "x"), [*DOC, "time_text"]).join(notes.select(*DOC, "text"), list(DOC))
    empty = F.lit("")
    details = pairs.select(
        *DOC,
        order(1, F.col("mb"), F.col("xb")).alias("sort_key"),
        F.col("mt").alias("med"),
        empty.alias("relation"),
        empty.alias("iso"),
        empty.alias("time_normal"),
        F.col("xt").alias("timex"),
        snippet(F.col("text"), F.col("mb"), F.col("me"), F.col("xb"), F.col("xe")).alias("snippet"),
    )
    return heads.unionByName(details)
