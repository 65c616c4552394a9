"""From notes to tables and timelines, as one declarative plan."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import align, header, parse, relations, sections, tables, timeline
from ..schemas import DOC, FAILED


def as_is(table: DataFrame, name: str) -> DataFrame:
    return table


@dataclass(frozen=True)
class Config:
    """What may be exchanged or added; every plug-in is a function from DataFrames to a DataFrame.

    ``prepare`` are steps that the notes go through before they are split, ``derive`` makes
    further tables of a run, which stand in its ``derived`` by their names.  ``keep`` gets
    the tables that several results read, a model's outputs before all, and their names; it
    may store them (``sinks.files.keeper``), so that each is made once.
    """

    prepare: tuple[Callable[[DataFrame], DataFrame], ...] = ()
    split: Callable[[DataFrame], DataFrame] = sections.whole_sections
    meta: Callable[[DataFrame], DataFrame] = header.doc_meta
    matching: align.Matching | None = field(default_factory=align.Matching)
    as_of: Column | None = None
    derive: Mapping[str, Callable[[Plan], DataFrame]] = field(default_factory=dict)
    keep: Callable[[DataFrame, str], DataFrame] = as_is


@dataclass(frozen=True)
class Plan:
    """The lazily evaluated tables of a run."""

    meta: DataFrame
    sections: DataFrame
    tlinks: DataFrame
    errors: DataFrame
    mentions: DataFrame
    normals: DataFrame
    table_rows: DataFrame
    span_rows: DataFrame
    mention_rows: DataFrame
    timeline: DataFrame
    patients: DataFrame
    derived: Mapping[str, DataFrame] = field(default_factory=dict)


def plan(notes: DataFrame, extract: Callable[[DataFrame], DataFrame], config: Config = Config()) -> Plan:
    """``extract`` turns sections into (doc key, section_id, llm_out)."""
    for step in config.prepare:
        notes = notes.transform(step)
    parts = config.split(notes)
    meta = header.anchor(config.meta(parts), notes, config.as_of)
    raw = config.keep(extract(parts), "outputs")
    tlinks, errors = parse.parse_outputs(raw)
    tlinks = config.keep(relations.number_tlinks(parse.guard_sections(tlinks, raw, parts, DOC)), "triplets")
    keep = None if config.keep is as_is else config.keep
    found = config.keep(align.mentions(tlinks, parts, config.matching, keep), "mentions")
    times = relations.normalize_mentions(found, meta, keep)
    normals = config.keep(relations.time_normals(relations.relations(tlinks), times), "normals")
    run = Plan(
        meta=meta,
        sections=parts,
        tlinks=tlinks,
        errors=errors,
        mentions=found,
        normals=normals,
        table_rows=tables.table_rows(normals),
        span_rows=tables.span_rows(normals, found),
        mention_rows=tables.mention_rows(normals, found, notes),
        timeline=timeline.resolve(timeline.instants(normals)),
        patients=notes.select("patient_id").distinct(),
    )
    return replace(run, derived={name: make(run) for name, make in config.derive.items()})


def counters(run: Plan) -> DataFrame:
    """(name, n) of what a run let go: outputs in quarantine, quotes found nowhere, times without a normal form."""
    texts = relations.concepts(run.tlinks, run.mentions)
    counted = (
        ("documents", run.meta),
        ("sections", run.sections),
        ("triplets", run.tlinks),
        ("outputs in quarantine", run.errors),
        ("texts without mention", texts.where(F.size("mentions") == 0)),
        ("relations without normal time", run.normals.where(F.col("time_type") == FAILED)),
        ("timeline rows", run.timeline),
    )
    rows = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in counted]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out
