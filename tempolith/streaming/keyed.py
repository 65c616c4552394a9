"""Timelines with one state for each patient: a batch costs what its own patients' links cost.

The state of a patient is the set of the links seen so far, an aggregate of Spark's own that
is kept in RocksDB under the query's checkpoint; no Python runs for a patient.  A batch's
links are added to the states of their patients, and only those patients' links come out, to
be resolved by the same plan as everywhere.  The order in which documents come plays no part;
a link that comes again changes nothing; a batch that broke off starts from the states before
it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.timeline import LINK, folded, resolve

_ORDER = ("doc_id", "tlink_id", *LINK)
_OUT = "patient_id string, doc_id string, tlink_id bigint, med_text string, relation string, time_normal string, added boolean"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def merged(links: DataFrame, dated: bool = False) -> DataFrame:
    """(patient_id, links, now): all links of the patients in a batch of a stream, and the batch's time.

    Each link is (doc_id, tlink_id, event, relation, time, since).  since is the time of the
    batch it came in if the links are ``dated``, when it has one element for each such batch;
    else it is null.
    """
    now = F.current_timestamp()
    since = now if dated else F.lit(None).cast("timestamp")
    each = links.select("patient_id", *_ORDER, since.alias("since"))
    return each.groupBy("patient_id").agg(F.collect_set(F.struct(*_ORDER, "since")).alias("links")).withColumn("now", now)


def distinct(states: DataFrame) -> DataFrame:
    """(patient_id, doc_id, tlink_id, event, relation, time, added): the distinct links of ``merged``.

    added marks links whose event, relation and time, letter case apart, came in this batch first.
    """
    each = states.select("patient_id", "now", F.inline("links"))
    # letter case is folded here, so that it is folded as in every other place
    first = each.groupBy("patient_id", *folded()).agg(F.min(F.struct(*_ORDER)).alias("first"), (F.min("since") >= F.max("now")).alias("added"))
    return first.select("patient_id", "first.*", "added")


def start(links: DataFrame, store: str, checkpoint: str, add=None) -> StreamingQuery:
    """Keep the timelines of a stream of links up to date in ``store``: everything there is, then stop.

    Each batch writes the timelines of its patients as their new version.  ``add`` is called
    with each batch's links that are new and its number.
    """
    spark = links.sparkSession
    states = merged(links, dated=add is not None)

    def take(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        touched = f"{store}/touched/batch={batch_id}"
        distinct(batch).write.mode("overwrite").parquet(touched)  # the states are read and written once
        rows = own.read.schema(_OUT).parquet(touched)
        if add is not None:
            add(rows.where("added").drop("added"), batch_id)
        found = resolve(rows.drop("added")).select("patient_id", *LINK)
        rows.select("patient_id").distinct().join(found, "patient_id", "left").write.mode("overwrite").parquet(f"{store}/timelines/batch={batch_id}")
        _remove(own, touched)

    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        return states.writeStream.outputMode("update").foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(_PROVIDER, before)


def _remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
