"""Extractors: sections to model outputs or triplets.

``recorded`` replays stored outputs, ``lexicon`` is a rule baseline, ``by_model`` runs any
callable from a list of instructions to a list of outputs in batches on the executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DOC, MAX_NEW_TOKENS
from .sections import instruction

#: cue words before a drug or after it; the rest is CONTAINS-1
BEGIN_CUES = r"(?i)\b(?:start(?:ed|ing)?|initiat(?:ed|ing|e)|began|begin(?:ning)?|commenced)\b"
END_CUES = r"(?i)\b(?:complet(?:ed|ing|e)|last|final|finished|discontinued|stopped|ended)\b"
TIME = (
    r"(?i)(?:(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\.? "
    r"(?:[0-9]{1,2}(?:st|nd|rd|th)?, )?[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|\b(?:yesterday|today)\b|\b[0-9]+ (?:day|week|month|year)s?(?: ago)?\b)"
)


def recorded(sections: DataFrame, outputs: DataFrame) -> DataFrame:
    """Stored outputs of ``sections``; sections without one have an empty list."""
    keys = [*DOC, "section_id"]
    joined = sections.select(*keys).join(outputs.select(*keys, "llm_out"), keys, "left")
    return joined.select(*keys, F.coalesce("llm_out", F.lit("[]")).alias("llm_out"))


def lexicon(sections: DataFrame, drugs: list[str]) -> DataFrame:
    """(doc key, section_id, pos, sact, relation, time) of drugs and times in one sentence."""
    pattern = r"(?i)\b(?:" + "|".join(sorted(drugs, key=len, reverse=True)) + r")\b"
    sentence = F.split("text", r"(?<=[.!?])\s+(?=[A-Z])")
    rows = sections.select(*DOC, "section_id", F.posexplode(sentence).alias("sentence_id", "sentence"))
    s = F.col("sentence")
    pairs = rows.where(s.rlike(pattern) & s.rlike(TIME))
    pairs = pairs.withColumn("sact", F.explode(F.array_distinct(F.regexp_extract_all(s, F.lit(pattern), F.lit(0)))))
    pairs = pairs.withColumn("time", F.explode(F.array_distinct(F.regexp_extract_all(s, F.lit(TIME), F.lit(0)))))
    relation: Column = F.when(s.rlike(BEGIN_CUES), "BEGINS-ON").when(s.rlike(END_CUES), "ENDS-ON").otherwise("CONTAINS-1")
    return pairs.select(*DOC, "section_id", F.col("sentence_id").alias("pos"), "sact", relation.alias("relation"), "time").distinct()


def as_outputs(tlinks: DataFrame, sections: DataFrame) -> DataFrame:
    """Triplets in the form of model outputs: one JSON list for each section, maybe empty."""
    keys = [*DOC, "section_id"]
    one = F.struct("pos", F.struct(F.col("sact").alias("SACT"), "relation", "time").alias("link"))
    lists = tlinks.groupBy(*keys).agg(F.to_json(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["link"])).alias("llm_out"))
    return recorded(sections, lists)


def prompt_length(mask: Column) -> Column:
    """Tokens of a prompt that was padded on its left: the ones in its mask."""
    return F.aggregate(mask, F.lit(0), lambda n, x: n + x.cast("int"))


def generated(ids: Column, mask: Column) -> Column:
    """The new tokens of an output that repeats its padded prompt."""
    padding = F.size(mask) - prompt_length(mask)
    return F.slice(ids, padding + prompt_length(mask) + 1, F.greatest(F.size(ids) - F.size(mask), F.lit(0)))


_models: dict[str, Callable] = {}


def _asked(model: Callable[..., list[str]], asks: list[str], more: dict) -> list[tuple[str | None, str | None]]:
    """(output, error) of each instruction; a batch that fails is halved until those that fail stand alone."""
    try:
        outputs = list(model(asks, **more))
        if len(outputs) != len(asks):
            raise ValueError(f"{len(outputs)} outputs of {len(asks)} instructions")
        return [(o, None) for o in outputs]
    except Exception as e:  # noqa: BLE001  whatever a model raises concerns its sections only
        if len(asks) == 1:
            return [(None, f"{type(e).__name__}: {e}")]
    half = len(asks) // 2
    return _asked(model, asks[:half], more) + _asked(model, asks[half:], more)


def by_model(sections: DataFrame, prompt: str, load: Callable[[], Callable[..., list[str]]], size: int = 4, max_new_tokens: int = MAX_NEW_TOKENS, limited: bool = False) -> DataFrame:
    """Outputs of a model, asked ``size`` sections at a time: (doc key, section_id, llm_out, error).

    ``load`` makes the model once in each Python worker: a callable from a list of
    instructions, and with ``limited`` from ``max_new_tokens`` too, to a list of outputs.
    Sections for which the model raises have no output but the error, which the parser puts
    into quarantine; all others go on.  A model that can't be loaded ends the job.
    """
    asked = sections.select(*DOC, "section_id", instruction(prompt, F.col("text")).alias("ask"))
    token = uuid.uuid4().hex
    more = {"max_new_tokens": max_new_tokens} if limited else {}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if token not in _models:
            _models.clear()
            _models[token] = load()
        for frame in frames:
            for i in range(0, len(frame), size):
                part = frame.iloc[i : i + size]
                found = _asked(_models[token], part["ask"].tolist(), more)
                yield part.drop(columns="ask").assign(llm_out=[o for o, _ in found], error=[e for _, e in found])

    return asked.mapInPandas(run, "patient_id string, doc_id string, section_id int, llm_out string, error string")
