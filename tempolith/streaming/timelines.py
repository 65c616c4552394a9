"""Timelines of a stream of links: exactly once, whatever the order of documents.

The links are kept as a table, a folder for each micro-batch; a batch that is run again
overwrites its own folder.  A patient's timeline is derived from all its links, so a document
that comes late changes its patient's timeline instead of starting another one.  A stream
keeps its patients' links in states (``keyed``) and writes the timelines it changes as their
new version; ``compact`` gathers the last versions.  ``refresh`` does the same for one batch
without a stream, from the parts of the table that its patients' hashes name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from ..operators.timeline import LINK, resolve
from . import keyed

LINKS = "patient_id string, doc_id string, tlink_id bigint, med_text string, relation string, time_normal string"
BUCKETS = 64
_COLUMNS = ("patient_id", "doc_id", "tlink_id", *LINK)
_TIMELINES = "patient_id string, med_text string, relation string, time_normal string"


def bucket(patient: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(patient), F.lit(buckets)).cast("int")


def add(links: DataFrame, store: str, batch_id: int) -> None:
    """Add one micro-batch of links; the same batch again takes its own place."""
    named = links.select(*_COLUMNS, bucket(F.col("patient_id")).alias("bucket"))
    # rebalanced: a file or a few for each bucket, not one for each bucket of each task
    named.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{store}/links/batch={batch_id}")


def refresh(links: DataFrame, store: str, batch_id: int) -> None:
    """Write the timelines of the patients of one micro-batch, which ``add`` has added.

    A patient whose links leave nothing has a row without event, which hides older versions.
    """
    spark = links.sparkSession
    changed = links.select("patient_id").distinct()
    parts = [r[0] for r in changed.select(bucket(F.col("patient_id"))).distinct().collect()]  # BUCKETS at most
    known = stored(spark, store).where(F.col("bucket").isin(parts) & (F.col("batch") <= batch_id)).join(changed, "patient_id", "left_semi")
    found = resolve(known).select("patient_id", *LINK)
    changed.join(found, "patient_id", "left").write.mode("overwrite").parquet(f"{store}/timelines/batch={batch_id}")


def start(links: DataFrame, store: str, checkpoint: str, keep_timelines: bool = False) -> StreamingQuery:
    """Add a stream of links to ``store``: everything there is, then stop.

    With ``keep_timelines`` each micro-batch also brings its patients' timelines up to date,
    from one state for each patient (``keyed``), and the store holds each distinct link once.
    An error ends the query; started again, it repeats the batch that broke off.
    """
    if keep_timelines:
        return keyed.start(links, store, checkpoint, lambda new, batch_id: add(new, store, batch_id))
    return links.writeStream.foreachBatch(lambda batch, batch_id: add(batch, store, batch_id)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def follow(spark: SparkSession, store: str, checkpoint: str) -> None:
    """Bring the timelines of a store up to date with the links that were added since the last call."""
    added = spark.readStream.schema(f"{LINKS}, batch bigint").parquet(f"{store}/links").drop("batch")
    keyed.start(added, store, checkpoint).awaitTermination()


def stored(spark: SparkSession, store: str) -> DataFrame:
    """All links of a store, with the batch they came in and the bucket of their patient."""
    return spark.read.schema(f"{LINKS}, batch bigint, bucket int").parquet(f"{store}/links")


def timelines(spark: SparkSession, store: str, patients: DataFrame | None = None) -> DataFrame:
    """Resolved timelines of all patients in a store, or only of those named."""
    links = stored(spark, store).select(*_COLUMNS)
    return resolve(links if patients is None else links.join(patients.select("patient_id").distinct(), "patient_id", "left_semi"))


def _versions(spark: SparkSession, store: str) -> DataFrame:
    """Timelines with the batch that wrote them: the last compaction and what came after it."""
    kind = f"{_TIMELINES}, batch bigint"
    every = spark.read.schema(kind).parquet(f"{store}/timelines")
    upto = _compacted(spark, store)
    if upto is None:
        return every
    return spark.read.schema(kind).parquet(f"{store}/compacted/upto={upto}").unionByName(every.where(F.col("batch") > upto))


def _compacted(spark: SparkSession, store: str) -> int | None:
    """The last batch that a finished compaction holds."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{store}/compacted")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    done = [f.getPath() for f in fs.listStatus(path) if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    return max((int(p.getName().split("=")[1]) for p in done), default=None)


def _newest(versions: DataFrame) -> DataFrame:
    newest = F.max("batch").over(Window.partitionBy("patient_id"))
    return versions.withColumn("newest", newest).where("batch = newest")


def compact(spark: SparkSession, store: str) -> int:
    """Write each patient's last version into one table, which readers then start from; returns its last batch.

    A compaction that broke off isn't read; batches that come in the meantime stay beside it.
    """
    versions = _versions(spark, store)
    upto = versions.agg(F.max("batch")).first()[0]
    kept = _newest(versions.where(F.col("batch") <= upto)).where("med_text is not null").select("patient_id", *LINK, "batch")
    kept.write.mode("overwrite").parquet(f"{store}/compacted/upto={upto}")
    return upto


def current(spark: SparkSession, store: str) -> DataFrame:
    """The timelines as the micro-batches have written them, each patient's last version."""
    return _newest(_versions(spark, store)).where("med_text is not null").select("patient_id", *LINK)
