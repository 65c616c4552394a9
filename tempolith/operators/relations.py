"""Concepts, time normalization of mentions and the relations between events and times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.iso import date_fields, date_iso, duration_fields, normal_text, time_class, time_fields
from ..schemas import DOC, DURATION, INSTANT
from .times import read_times


def number_tlinks(tlinks: DataFrame) -> DataFrame:
    """``tlinks`` with ``tlink_id``, from 0 in each document, in the order of section and place."""
    order = Window.partitionBy(*DOC).orderBy("section_id", "pos", "sact", "time", "relation")
    return tlinks.withColumn("tlink_id", F.row_number().over(order) - 1)


def concepts(tlinks: DataFrame, mentions: DataFrame) -> DataFrame:
    """One concept for each distinct text of a document and kind, with its mentions (maybe none)."""
    texts = tlinks.select(*DOC, F.explode(F.array(F.struct(F.lit("MED").alias("kind"), F.col("sact").alias("t")), F.struct(F.lit("TIME").alias("kind"), F.col("time").alias("t")))).alias("c"))
    texts = texts.select(*DOC, "c.kind", F.col("c.t").alias("concept_text")).distinct()
    spans = F.array_sort(F.collect_set(F.struct("begin", "end", "covered_text", "confidence")))
    found = mentions.groupBy(*DOC, "kind", "concept_text").agg(spans.alias("mentions"))
    joined = texts.join(found, [*DOC, "kind", "concept_text"], "left")
    return joined.withColumn("mentions", F.coalesce("mentions", F.expr("cast(array() as array<struct<begin:int,end:int,covered_text:string,confidence:double>>)")))


def relations(tlinks: DataFrame) -> DataFrame:
    """Edges: (doc key, tlink_id, category, med_text, time_text)."""
    return tlinks.select(*DOC, "tlink_id", F.col("relation").alias("category"), F.col("sact").alias("med_text"), F.col("time").alias("time_text"))


def with_mentions(edges: DataFrame, concepts: DataFrame) -> DataFrame:
    """``edges`` with ``med_mentions`` and ``time_mentions`` of their two concepts, null where there is no concept."""
    for kind, text, name in (("MED", "med_text", "med_mentions"), ("TIME", "time_text", "time_mentions")):
        own = concepts.where(F.col("kind") == kind).select(*DOC, F.col("concept_text").alias(text), F.col("mentions").alias(name))
        edges = edges.join(own, [*DOC, text], "left")
    return edges


def normalize_mentions(mentions: DataFrame, meta: DataFrame, keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """TIME mentions with iso, time_class and the structs that fit their class.

    Each distinct (text, document date) is normalized once; a document without date
    still has its absolute expressions read.  first_day and last_day are the days an
    expression names, time_kind, about and readings tell how it was read.
    """
    times = mentions.where("kind = 'TIME'").join(meta.select(*DOC, "doc_ts", "doc_date"), list(DOC), "left")
    texts = read_times(times.select("covered_text", "doc_date"), keep=keep)
    same = (times["covered_text"] == texts["covered_text"]) & times["doc_date"].eqNullSafe(texts["doc_date"])
    out = times.join(texts, same).select(times["*"], *(texts[c] for c in ("iso", "first_day", "last_day", "time_kind", "about", "readings"))).withColumn("time_class", time_class(F.col("iso")))
    iso, kind, ts = F.col("iso"), F.col("time_class"), F.col("doc_ts")
    return out.withColumns({
        "time": time_fields(iso, ts),
        "date": F.when(kind == INSTANT, date_fields(iso, ts)),
        "duration": F.when(kind == DURATION, duration_fields(iso)),
        "time_normal": normal_text(iso, ts),
    })


def time_normals(relations: DataFrame, times: DataFrame) -> DataFrame:
    """Relations joined to the normalized mentions of their times, each distinct.

    A relation whose time occurs nowhere has no row.
    """
    of = times.select(
        *DOC,
        F.col("concept_text").alias("time_text"),
        F.col("time_class").alias("time_type"),
        "time_normal",
        F.when(F.col("time_class") == INSTANT, date_iso(F.col("iso"))).otherwise(F.col("iso")).alias("iso"),
        F.col("covered_text").alias("timex"),
        F.concat_ws(",", F.col("begin").cast("string"), F.col("end").cast("string")).alias("timex_span"),
    )
    joined = relations.join(of, [*DOC, "time_text"])
    return joined.dropDuplicates([*DOC, "tlink_id", "time_type", "time_normal", "iso", "timex", "timex_span"])
