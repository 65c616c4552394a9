"""python -m tempolith --notes DIR --recorded FILE --out DIR [--tables bsv,html] [--sections], or --script FILE"""

from __future__ import annotations

import argparse
import functools
import os
import uuid

from pyspark.sql import SparkSession

from .operators import align, extract, header, sections, tables, timeline
from .plans import script
from .plans.notes_to_timeline import Config, counters, plan
from .schemas import MENTION_HEADER, SPAN_HEADER, TABLE_HEADER
from .sinks import files, render
from .sources.notes import corpus_name, read_notes, read_recorded


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    """Run the command line; with a session given, that one is used and stays."""
    p = argparse.ArgumentParser(prog="tempolith", description="Notes to tables and timelines.")
    p.add_argument("--script", help="a run's file with any of these options, variables as ${name}")
    p.add_argument("--set", action="append", default=[], metavar="NAME=VALUE", help="a variable of the run's file")
    p.add_argument("--notes", help="folder of patient/doc.txt")
    p.add_argument("--recorded", help="JSON lines of model outputs; without it the drug list is searched for")
    p.add_argument("--drugs", default="", help="comma-separated list for the rule-based extractor")
    p.add_argument("--out", help="folder that driver and executors share")
    p.add_argument("--institution", help="where the notes come from")
    p.add_argument("--tables", default="bsv", help=f"comma-separated of {', '.join(render.FORMATS)}")
    p.add_argument("--sections", action="store_true", help="split notes at their titles")
    p.add_argument("--exact", action="store_true", help="no fuzzy alignment")
    p.add_argument("--threshold", type=float, default=align.Matching.threshold)
    args = p.parse_args(argv)
    if args.script:
        options = script.read(args.script, dict(v.split("=", 1) for v in args.set))
        options.pop("set")
        p.set_defaults(**options)
        args = p.parse_args(argv)
    if not args.notes or not args.out:
        p.error("--notes and --out are needed")
    own = spark is None
    spark = spark or SparkSession.builder.appName("tempolith").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    config = Config(
        split=sections.titled_sections if args.sections else sections.whole_sections,
        matching=None if args.exact else align.Matching(threshold=args.threshold),
        meta=functools.partial(header.doc_meta, institution=args.institution),
        keep=files.keeper(work := f"{args.out}/_work-{uuid.uuid4().hex}"),
    )
    if args.recorded:
        recorded = read_recorded(spark, args.recorded)
        take = lambda s: extract.recorded(s, recorded)
    else:
        take = lambda s: extract.as_outputs(extract.lexicon(s, args.drugs.split(",")), s)
    run = plan(read_notes(spark, args.notes), take, config)
    kinds = (("medTimes", run.table_rows, TABLE_HEADER, tables.ROW7), ("medTimeSpans", run.span_rows, SPAN_HEADER, tables.ROW9), ("medTimeMentions", run.mention_rows, MENTION_HEADER, tables.ROW6))
    for form in args.tables.split(","):
        for suffix, rows, names, columns in kinds:
            content = render.document_tables(rows, form, names, list(columns), ["patient_id", "doc_id"])
            files.write_documents(content, args.out, suffix, form).count()
    os.makedirs(args.out, exist_ok=True)
    files.write_corpus_json(timeline.patient_entries(run.timeline, run.patients), os.path.join(args.out, f"{corpus_name(args.notes)}_medTlinks.json"))
    for name, n in counters(run).collect():
        print(f"{n:>12,}  {name}")
    files.remove(spark, work)
    if own:
        spark.stop()


if __name__ == "__main__":
    main()
