"""A stream of notes or messages through the whole plan, micro-batch by micro-batch.

Links go to the store of ``timelines``.  What can't be read, a message or a model's output,
goes to a quarantine beside it, and counters tell how many of each there were.  All three
are written under the batch's number, so a batch that is run again leaves nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import timeline
from ..plans.notes_to_timeline import Config, counters, plan
from ..schemas import STOP
from ..sinks import files
from . import timelines

MESSAGE = "kind string, corpus string, patient_id string, doc_id string, mtime timestamp, text string"


def stream_messages(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """JSON lines as a stream of messages; a line that is none is kept as it is in ``malformed``."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    read = F.from_json("value", f"{MESSAGE}, malformed string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"})
    return lines.select(read.alias("m"), "value").select("m.*", F.col("value").alias("line"))


def route(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(notes, malformed) of messages: notes have a document's key and a text; STOP marks end nothing but their own line."""
    stop = F.coalesce(F.col("kind"), F.lit("")) == STOP
    good = F.col("malformed").isNull() & F.col("patient_id").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    notes = messages.where(good & ~stop).select("corpus", "patient_id", "doc_id", "mtime", "text")
    return notes, messages.where(~good & ~stop).select("line")


def start(stream: DataFrame, extract: Callable[[DataFrame], DataFrame], store: str, checkpoint: str, config: Config = Config()) -> StreamingQuery:
    """Run notes (``sources.notes.stream_notes``) or messages (``stream_messages``) into ``store``: everything there is, then stop.

    A batch asks the model once: its outputs are stored before anything reads them.  Its links
    then go to the states of their patients, under a checkpoint of their own beside the first.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        notes = batch
        if "line" in batch.columns:
            notes, malformed = route(batch)
            malformed.write.mode("overwrite").text(f"{store}/malformed/batch={batch_id}")
        work = f"{store}/work/batch={batch_id}"
        run = plan(notes, extract, replace(config, keep=files.keeper(work)))
        links = timeline.instants(run.normals)
        timelines.add(links, store, batch_id)
        timelines.follow(notes.sparkSession, store, f"{checkpoint}-timelines")
        run.errors.write.mode("overwrite").parquet(f"{store}/errors/batch={batch_id}")
        counters(run).write.mode("overwrite").parquet(f"{store}/counters/batch={batch_id}")
        files.remove(notes.sparkSession, work)

    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
