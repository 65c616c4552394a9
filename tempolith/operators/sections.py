"""Sections of notes, model instructions and batches of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import SPACES, batch
from ..schemas import DOC

TITLE = r"(?m)^(?=[A-Z][A-Z /]*::)"


def whole_sections(notes: DataFrame) -> DataFrame:
    """One section for each note: all of it."""
    return notes.select(*DOC, F.lit(0).alias("section_id"), F.lit(0).alias("begin"), F.length("text").alias("end"), "text")


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _running(lengths: pa.Array) -> pa.Array:
    """Running sums within each list."""
    flat = lengths.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    size = pc.fill_null(pc.list_value_length(lengths), 0).to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    total = np.concatenate([[0], np.cumsum(flat)])
    ends = total[1:] - np.repeat(total[bounds[:-1]], size)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(ends.astype(np.int32)))


def _placed(docs: DataFrame, keys: tuple[str, ...], parts: Column, gap: int) -> DataFrame:
    """(keys, section_id, text, begin, end) of consecutive parts that were ``gap`` characters apart.

    Lengths are summed up within a row, so nothing is shuffled and two rows of one key don't meet.
    """
    rows = docs.select(*keys, parts.alias("parts"))
    ends = rows.withColumn("ends", _running(F.transform("parts", lambda p: F.length(p) + gap)))
    each = ends.select(*keys, F.posexplode(F.arrays_zip(F.col("parts").alias("text"), F.col("ends").alias("end"))).alias("section_id", "part"))
    each = each.select(*keys, "section_id", F.col("part.text").alias("text"), (F.col("part.end") - gap).alias("end"))
    return each.withColumn("begin", F.col("end") - F.length("text"))


def titled_sections(notes: DataFrame, title: str = TITLE) -> DataFrame:
    """Sections that start at title lines; what precedes the first title is section 0."""
    return _placed(notes, DOC, F.split("text", title), 0).select(*DOC, "section_id", "begin", "end", "text")


def line_sections(docs: DataFrame, keys: tuple[str, ...] = DOC) -> DataFrame:
    """Every line as a section."""
    return _placed(docs, keys, F.split("text", "\n"), 1).select(*keys, "section_id", "begin", "end", "text")


def _pieces(docs: DataFrame, keys: tuple[str, ...], pattern: str, name: str) -> DataFrame:
    """Matches of a pattern that covers the whole text, without white space around them, with offsets."""
    placed = _placed(docs, keys, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), 0)
    lead = F.length("text") - F.length(F.ltrim("text", F.lit(SPACES)))
    placed = placed.withColumns({"begin": F.col("begin") + lead, "text": F.btrim("text", F.lit(SPACES))}).where("text <> ''")
    return placed.select(*keys, F.col("section_id").alias(name), "begin", (F.col("begin") + F.length("text")).alias("end"), "text")


def sentences(docs: DataFrame, keys: tuple[str, ...] = DOC) -> DataFrame:
    """(keys, sentence_id, begin, end, text): stretches up to marks of their end; ids may have gaps where nothing but space stands.

    ``sentences.split`` tells abbreviations and decimals from ends.
    """
    return _pieces(docs, keys, r"[^.!?]*[.!?]+|[^.!?]+$", "sentence_id")


def tokens(docs: DataFrame, keys: tuple[str, ...] = DOC) -> DataFrame:
    """(keys, token_id, begin, end, text): words, and every character that is neither letter, digit nor space by itself."""
    return _pieces(docs, keys, r"[\x20\x09-\x0D]*+(?:[\p{L}\p{N}]+|[^\x20\x09-\x0D\p{L}\p{N}])|[\x20\x09-\x0D]++$", "token_id")


def instruction(prompt: str, text: Column) -> Column:
    """What a model is asked about one section."""
    return F.concat(F.lit(prompt), text, F.lit("/no_think"))


def messages(prompt: str, text: Column) -> Column:
    return F.array(F.struct(F.lit("user").alias("role"), instruction(prompt, text).alias("content")))


def chat(messages: Column, opening: str = "<|im_start|>", closing: str = "<|im_end|>", role: str = "assistant") -> Column:
    """Messages as one text for a model, which goes on in ``role``; the marks are the model's."""
    said = F.transform(messages, lambda m: F.concat(F.lit(opening), m["role"], F.lit("\n"), m["content"], F.lit(f"{closing}\n")))
    return F.concat(F.array_join(said, ""), F.lit(f"{opening}{role}\n"))


def batches(sections: DataFrame, size: int = 4) -> DataFrame:
    """``sections`` with the number of the batch in which a section is sent to a model."""
    return sections.withColumn("batch_id", batch(F.col("section_id"), size))
