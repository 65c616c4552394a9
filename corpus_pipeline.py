"""Corpus cleaning in five stages; each takes (spark, docs, sf_dir) and returns a DataFrame.

All stages but the last return the columns they were given.  A row is named by its doc_id and
text together, so a doc_id may stand for several texts; a row without doc_id can't be named by a
verdict and stays; a null text counts as empty, which has no language and goes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolith.llm import langid, probminhash, pseudonyms, sentencepiece_codec, spaced_seeds, storage
from tempolith.llm.queries import MODEL, PSEUDONYM_KEY, table

#: texts that resemble no profile by more than this have no language
MIN_SCORE = 0.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told by the profiles learned from these documents."""
    learned = langid.learn(docs.where(langid.fold(F.col("doc_id")) != 0))
    told, score = (storage.unused(name, docs.columns) for name in ("__lang_pred", "__score"))
    judged = langid.predict(docs, learned, keep=tuple(docs.columns), names=(told, score))
    return judged.where((F.col(told) != langid.UNDETERMINED) & (F.col(score) >= MIN_SCORE)).select(storage.quoted(docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the least id; of its repeated rows (same id and text) one."""
    return probminhash.thinned(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return spaced_seeds.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with pseudonyms in their texts, n_chars following."""
    named = pseudonyms.pseudonymise(docs, PSEUDONYM_KEY, count=None)
    if "n_chars" in docs.columns:
        named = named.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return named.select(storage.quoted(docs.columns))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of what is left; the last stage returns digests instead of documents."""
    return sentencepiece_codec.digests(docs, public_tokenizers.path(MODEL))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("sentencepiece", encoding),
]

#: SQL expresses neither the language profiles nor the near-duplicate search; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = storage.materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
