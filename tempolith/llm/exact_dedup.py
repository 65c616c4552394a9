"""Exact deduplication against a persistent index of digests.

The index is a table of one row for each distinct text seen so far, bucketed and sorted by
the text's SHA-256.  A batch of documents is digested where it is read, grouped by digest
(counts and largest ids are partial aggregates, so a text that fills a third of the batch
is a row for each task), anti-joined to the index by a sort-merge join that reads the
index's buckets without shuffling them, and what is new is appended.  Texts themselves
are never shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import materialise, quoted, release, unused

BUCKETS = 32


def digest(text: Column, normalise: Callable[[Column], Column] | None = None) -> Column:
    """SHA-256 of a text in UTF-8, after ``normalise`` if it is given; a null text counts as empty."""
    plain = F.coalesce(text, F.lit(""))
    return F.unhex(F.sha2((normalise(plain) if normalise else plain).cast("binary"), 256))


@dataclass(frozen=True)
class DigestIndex:
    """Entries (digest, keep_id, n, batch) in a folder that outlives the session.

    batch names the batch that brought a text in, keep_id the row that stays of it, n how
    many rows of that batch have the text.  A bucket should hold some millions of entries:
    the number of buckets is the index's own and is told again when it is opened.
    """

    spark: SparkSession
    path: str
    table: str
    buckets: int

    @classmethod
    def create(cls, spark: SparkSession, path: str, id_type: str = "bigint", buckets: int = BUCKETS) -> DigestIndex:
        """An empty index; ``path`` must hold nothing yet."""
        none = spark.createDataFrame([], f"digest binary, keep_id {id_type}, n bigint, batch string")
        index = cls(spark, path, f"digests_{uuid.uuid4().hex}", buckets)
        index._write(none, "errorifexists")
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int, id_type: str = "bigint") -> DigestIndex:
        """The index another session has left in ``path``."""
        name, where = f"digests_{uuid.uuid4().hex}", path.replace("'", "\\'")
        spark.sql(f"create table {name} (digest binary, keep_id {id_type}, n bigint, batch string) using parquet clustered by (digest) sorted by (digest) into {buckets} buckets location '{where}'")
        return cls(spark, path, name, buckets)

    def _write(self, entries: DataFrame, mode: str) -> None:
        entries.write.format("parquet").option("path", self.path).bucketBy(self.buckets, "digest").sortBy("digest").mode(mode).saveAsTable(self.table)

    def entries(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, entries: DataFrame) -> None:
        self._write(entries.select("digest", "keep_id", "n", "batch"), "append")

    def compacted(self, path: str) -> DigestIndex:
        """The same entries in another folder, in one sorted file for each bucket however many batches brought them."""
        kind = self.entries().schema["keep_id"].dataType.simpleString()
        index = DigestIndex.create(self.spark, path, kind, self.buckets)
        index.append(self.entries().repartition(self.buckets, "digest"))
        return index

    def forget(self) -> None:
        """Leave the session's catalogue; the folder stays."""
        self.spark.sql(f"drop table if exists {self.table}")


def deduplicate(docs: DataFrame, index: DigestIndex, batch: str = "0", normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept and digest for every row of ``docs`` (doc_id, text); new texts enter ``index``.

    Of equal texts of a batch the row with the largest doc_id stays, unless an earlier batch
    has brought the text in: then none stays and keep_id is the earlier row's.  group_size
    counts the batch's rows.  A null text counts as empty, and empty texts are equal.  A row
    without doc_id stays only where no row of its text has one; of repeated rows (same
    doc_id and text) one stays.  Texts of any length are digested whole, other columns aren't
    read, and an empty batch has no rows.

    A batch that broke off is run again under its name: the entries it has left count as
    its own, so it gives the same result.
    """
    rows = docs.select("doc_id", digest(F.col("text"), normalise).alias("digest"))
    # a table, as the row's number decides between repeated rows and must not change
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "digests")
    groups = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("last"), F.count("*").alias("n"))
    groups = materialise(groups.select("digest", F.col("last.doc_id").alias("keep_id"), F.col("last.row").alias("keep_row"), "n"), "groups")
    # dealt out as the index is, so that only the batch's side moves
    dealt = groups.repartition(index.buckets, "digest").withColumn("batch", F.lit(batch))
    known = index.entries().select("digest")
    index.append(dealt.join(known.hint("merge"), "digest", "left_anti"))
    own = index.entries().select("digest", F.col("keep_id").alias("first_id"), (F.col("batch") == batch).alias("own"))
    settled = dealt.join(own.hint("merge"), "digest").select(
        "digest",
        F.when(F.col("own"), F.col("keep_id")).otherwise(F.col("first_id")).alias("keep_id"),
        F.when(F.col("own"), F.col("keep_row")).alias("keep_row"),
        "n",
    )
    settled = materialise(settled, "settled")
    release(groups)
    # a plain equi-join: adaptive execution splits the digest that many rows have
    told = rows.join(settled, "digest")
    return told.select("doc_id", "keep_id", F.col("n").alias("group_size"), F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"), "digest")


def new_documents(docs: DataFrame, index: DigestIndex, batch: str = "0", normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are."""
    key = unused("__digest", docs.columns)
    kept = materialise(deduplicate(docs, index, batch, normalise).where("kept").select(F.col("doc_id").alias("kept_id"), F.col("digest").alias(key)), "kept")
    keyed = docs.withColumn(key, digest(F.col("text"), normalise))
    same = (keyed[key] == kept[key]) & keyed["doc_id"].eqNullSafe(kept["kept_id"])
    once = keyed.join(kept.select(key, "kept_id"), same, "left_semi")
    # most rows are the only one of their doc_id and text; the few that repeat meet by key
    often = materialise(once.groupBy("doc_id", key).agg(F.count("*").alias("n")).where("n > 1").select("doc_id", key), "repeated")
    columns = quoted(docs.columns)
    if often.isEmpty():
        return once.select(columns)
    both = once["doc_id"].eqNullSafe(often["doc_id"]) & (once[key] == often[key])
    alone = once.join(often, both, "left_anti").select(columns)
    return alone.union(once.join(often, both, "left_semi").dropDuplicates(["doc_id", key]).select(columns))


def report(docs: DataFrame, path: str) -> DataFrame:
    """The contract's columns for all of ``docs``, as the first batch of a new index in ``path``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    index = DigestIndex.create(docs.sparkSession, path, id_type)
    found = deduplicate(docs, index)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
