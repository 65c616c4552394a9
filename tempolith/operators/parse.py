"""Model output to triplets, with a quarantine for what can't be read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.literals import literal_tlinks
from ..functions.text import bracketed, let, strip_think
from ..schemas import DOC, TLINK_JSON, UNKNOWN


_STRING = r"""\"[^\"\\]*+(?:\\.[^\"\\]*+)*+\"|'[^'\\]*+(?:\\.[^'\\]*+)*+'"""
#: strings, which stay, and commas before a closing bracket, which go
_COMMAS = rf"(?s)({_STRING})|,(?=\s*[\]}}])"
#: strings, the word None, and what is between them
_WORDS = rf"(?s){_STRING}|\bNone\b|[^\"'N]++|."


def json_tlinks(body: Column) -> Column:
    """Triplets of a bracketed list as JSON; null where that fails."""
    found = F.from_json(body, TLINK_JSON, {"mode": "PERMISSIVE"})
    return let(found, lambda x: F.when(~F.exists(x, lambda link: link.isNull()), x))


def repaired(body: Column) -> Column:
    """A list with what Python writes otherwise than JSON put right: commas behind the last item, None."""
    without = F.regexp_replace(body, _COMMAS, "$1")
    words = F.transform(F.regexp_extract_all(without, F.lit(_WORDS), F.lit(0)), lambda w: F.when(w == "None", "null").otherwise(w))
    return F.array_join(words, "")


def with_defaults(link: Column) -> list[Column]:
    """sact, relation and time of a triplet; a missing or null field gets its placeholder."""
    return [F.coalesce(link[field], F.lit(UNKNOWN[name])).alias(name) for name, field in (("sact", "SACT"), ("relation", "relation"), ("time", "time"))]


def parse_outputs(raw: DataFrame, out: str = "llm_out") -> tuple[DataFrame, DataFrame]:
    """(tlinks, errors): exploded triplets with their place ``pos``, and the rows that can't be read.

    One pass in the JVM: lists are read as JSON, else as JSON after a repair of what Python
    spells otherwise.  Only texts that are neither go to Python, where they may still be
    literals; what is none is quarantined and its document goes on.  A column ``error`` of
    ``raw`` goes with the quarantine.
    """
    keys = [c for c in raw.columns if c not in (out, "error")]
    told = ["error"] if "error" in raw.columns else []
    body = raw.select(*keys, *told, out, bracketed(strip_think(F.col(out))).alias("__body"))
    # a repair is tried only where there is something to mend
    tried = body.withColumn("__json", F.coalesce(json_tlinks(F.col("__body")), F.when(F.col("__body").rlike(r"None\b|,\s*[\]}]"), json_tlinks(repaired(F.col("__body"))))))
    read = tried.withColumn("__literal", literal_tlinks(F.when(F.col("__json").isNull(), F.col("__body"))))
    read = read.select(*keys, *told, out, F.coalesce("__json", "__literal").alias("links"))
    # outer, so that the list isn't read once more to filter empty ones
    each = read.select(*keys, F.posexplode_outer("links").alias("pos", "link")).where("pos is not null")
    return each.select(*keys, "pos", *with_defaults(F.col("link"))), read.where("links is null").select(*keys, out, *told)


def section_counts(tlinks: DataFrame, keys: tuple[str, ...] = (*DOC, "section_id")) -> DataFrame:
    """``keys`` and n: triplets of each section that has any."""
    return tlinks.groupBy(*keys).agg(F.count("*").alias("n"))


def output_map(out: Column) -> Column:
    """A model's output as a map of strings; what is no JSON object stands under ``llm_out`` as it is."""
    found = F.from_json(bracketed(strip_think(out), "{", "}"), "map<string,string>", {"mode": "PERMISSIVE"})
    return F.coalesce(found, F.create_map(F.lit("llm_out"), out))


def has_links(tlinks: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Documents with any triplet: those that go through alignment."""
    return tlinks.select(*keys).distinct()


def guard_sections(tlinks: DataFrame, raw: DataFrame, sections: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Triplets of the documents whose outputs are as many as their sections; the others import nothing."""
    outputs = raw.groupBy(*keys).agg(F.count("*").alias("outputs"))
    counts = sections.groupBy(*keys).agg(F.count("*").alias("sections"))
    same = outputs.join(counts, list(keys)).where("outputs = sections").select(*keys)
    return tlinks.join(same, list(keys), "left_semi")
