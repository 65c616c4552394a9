"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import divergence, exact_dedup, fill_in_middle, langid, oracles, probminhash, pseudonyms, quality, secrets, sentencepiece_codec, sharding, spaced_seeds, storage, token_shards, url_filter

MODEL = "piece_bpe_32k.model"
#: the key of the pseudonyms in these queries; a deployment passes its own secret
PSEUDONYM_KEY = "tempolith"
SHUFFLE_KEY = "epoch 0"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))


def op2_training_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = storage.fresh_path(spark, "shards")
    told, _ = token_shards.write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL), folder, SHUFFLE_KEY)
    return told


def op3_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)


def op4_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op5_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    # every shingle has weight 1: counts as weights make texts alike that share one line often (README)
    return probminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seeds.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op8_credential_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op9_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op10_rank_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.report(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.report(table(spark, sf_dir, "documents"))


def op13_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.report(table(spark, sf_dir, "documents"), storage.fresh_path(spark, "digest-index"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_training_shards": op2_training_shards,
    "op3_feistel_pseudonyms": op3_feistel_pseudonyms,
    "op4_redirect_equivalence": op4_redirect_equivalence,
    "op5_probminhash": op5_probminhash,
    "op6_spaced_seeds": op6_spaced_seeds,
    "op7_label_propagation": op7_label_propagation,
    "op8_credential_linking": op8_credential_linking,
    "op9_adaptive_quality": op9_adaptive_quality,
    "op10_rank_profiles": op10_rank_profiles,
    "op11_source_divergence": op11_source_divergence,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_digest_index": op13_digest_index,
}

ORACLE: dict[str, str] = {
    "op4_redirect_equivalence": oracles.REDIRECT_EQUIVALENCE,
    "op9_adaptive_quality": oracles.ADAPTIVE_QUALITY,
    "op11_source_divergence": oracles.SOURCE_DIVERGENCE,
    "op12_fill_in_middle": oracles.FILL_IN_MIDDLE,
    "op13_digest_index": oracles.DIGEST_INDEX,
}
