"""Patient timelines: distinct links, conflict resolution, JSON entries.

Links are (patient_id, doc_id, tlink_id, med_text, relation, time_normal).  They are equal
where the three texts are, letter case apart; the spelling that stays is that of the first
link by (doc_id, tlink_id), and by the texts themselves where those are equal too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schemas import INSTANT

LINK = ("med_text", "relation", "time_normal")
MERGED = "contains-1"


def folded(names: tuple[str, ...] = LINK) -> list[Column]:
    return [F.lower(n).alias(f"__{n}") for n in names]


def instants(normals: DataFrame) -> DataFrame:
    """Links of the relations whose time is an instant; the timeline shows no others."""
    picked = normals.where(F.col("time_type") == INSTANT)
    shown = F.when(F.lower("iso") == "present_ref", F.substring("time_normal", 1, 10)).otherwise(F.col("iso"))
    return picked.select("patient_id", "doc_id", "tlink_id", "med_text", F.col("category").alias("relation"), shown.alias("time_normal"))


def distinct_links(links: DataFrame) -> DataFrame:
    """Distinct links of each patient, with the order of the first."""
    order = F.struct("doc_id", "tlink_id", *LINK)
    first = links.groupBy("patient_id", *folded()).agg(F.min(order).alias("first"))
    return first.select("patient_id", "first.*").select("patient_id", *LINK, "doc_id", "tlink_id")


def resolve(links: DataFrame) -> DataFrame:
    """Timeline rows (patient_id, med_text, relation, time_normal) without contradictions.

    For one event and one time: a begin and an end become one ``contains-1``; a begin or an
    end alone drops the containment; relations of other kinds stay as they are.
    """
    rows = distinct_links(links)
    group = Window.partitionBy("patient_id", F.lower("med_text"), F.lower("time_normal"))
    relation = F.lower("relation")
    kinds = {"b": relation.startswith("begin"), "e": relation.startswith("ends"), "c": relation.startswith("contains")}
    rows = rows.withColumns(kinds)
    rows = rows.withColumns({"has_b": F.bool_or("b").over(group), "has_e": F.bool_or("e").over(group)})
    both = F.col("has_b") & F.col("has_e")
    dropped = (both & (F.col("b") | F.col("e"))) | ((F.col("has_b") | F.col("has_e")) & F.col("c"))
    kept = rows.where(~dropped).select("patient_id", *LINK)
    order = F.struct("doc_id", "tlink_id", *LINK)
    pairs = rows.where(both & (F.col("b") | F.col("e"))).groupBy("patient_id", F.lower("med_text").alias("__med"), F.lower("time_normal").alias("__time")).agg(F.min(order).alias("first"))
    merged = pairs.select("patient_id", "first.med_text", F.lit(MERGED).alias("relation"), "first.time_normal")
    return kept.unionByName(merged)


def union_links(a: DataFrame, b: DataFrame) -> DataFrame:
    return distinct_links(a.unionByName(b))


def except_links(links: DataFrame, removed: DataFrame) -> DataFrame:
    """``links`` without those that equal one of ``removed``."""
    names = [f"__{n}" for n in LINK]
    gone = removed.select("patient_id", *folded()).distinct()
    return links.select("*", *folded()).join(gone, ["patient_id", *names], "left_anti").drop(*names)


def patient_entries(timeline: DataFrame, patients: DataFrame | None = None) -> DataFrame:
    """(patient_id, entries): sorted [event, relation, time] triples, an empty array for patients without."""
    triples = timeline.groupBy("patient_id").agg(F.array_sort(F.collect_list(F.array(*LINK))).alias("entries"))
    if patients is not None:
        triples = patients.select("patient_id").distinct().join(triples, "patient_id", "left")
    return triples.withColumn("entries", F.coalesce("entries", F.expr("cast(array() as array<array<string>>)")))


def patient_json(timeline: DataFrame, patients: DataFrame | None = None) -> DataFrame:
    """(patient_id, json): the entries as escaped JSON."""
    return patient_entries(timeline, patients).select("patient_id", F.to_json("entries").alias("json"))
