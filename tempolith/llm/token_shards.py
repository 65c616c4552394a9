"""Token shards in training order.

Texts are encoded and packed into sequences of equal length.  A keyed Feistel permutation
with cycle-walking gives every sequence its own slot of 0 .. N-1, and shard k holds slots
k * shard_rows and up, in order, at a fixed stride: a trainer reads one file after the
other and resumes at any slot by a seek.

A record is ``length`` token ids, little-endian, of two bytes where the vocabulary allows,
else four; its last one is always the end id, which doubles as the record separator that
Spark's text writer puts, so that any Hadoop file system, the commit protocol and retried
tasks are served by Spark itself.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from dataclasses import dataclass
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .pseudonyms import permute_index
from .sentencepiece_codec import chunk_table, text_blocks
from .storage import materialise, reread
from .textkernel import tidied

LENGTH = 1024
SHARD_BYTES = 16 << 20
PAD = 0
WAVES = 2
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class Layout:
    """What a reader needs besides the files."""

    folder: str
    sequences: int
    length: int
    width: int
    shard_rows: int

    @property
    def stride(self) -> int:
        return self.length * self.width


def pack(docs: DataFrame, model: str, length: int = LENGTH) -> tuple[DataFrame, int]:
    """Sequences of ``length`` - 1 ids, and the bytes of an id.

    Rows: first_doc_id (the document of the first id), first_at (its place in that
    document), n_tokens (ids that aren't padding), ids_crc32, ids.  Documents follow each other in
    the order of the table's partitions, each with its begin id and its end id; only the
    last sequence of a partition is padded.  A null text counts as empty.
    """
    table = chunk_table(model)
    width = 2 if table.sp.vocab_size() <= 1 << 16 else 4
    kind = f"<u{width}"

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, size = chunk_table(model), length - 1
        held = np.zeros(0, kind)  # ids that don't fill a sequence yet
        starts, ids_of = np.zeros(0, np.int64), []  # where documents start in ``held``, and their ids

        def rows(n: int) -> pa.RecordBatch:
            at = np.arange(n) * size
            doc = np.searchsorted(starts, at, "right") - 1
            body = np.full(n * size, PAD, kind)
            body[: min(len(held), n * size)] = held[: n * size]
            raw = pa.py_buffer(body.tobytes())
            ends = pa.py_buffer(np.arange(0, n * size * width + 1, size * width, dtype=np.int32))
            sums = pa.array([zlib.crc32(record) for record in body.reshape(n, size)], pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([ids_of[d] for d in doc]), pa.array(at - starts[doc]), pa.array(np.minimum(len(held) - at, size)), sums, pa.Array.from_buffers(pa.binary(), n, [None, ends, raw])],
                names=["first_doc_id", "first_at", "n_tokens", "ids_crc32", "ids"],
            )

        for batch in batches:
            at = 0
            for texts in text_blocks(batch.column(1)):
                found, _ = table.encode(texts, decoded=False)
                bounds = np.frombuffer(found.buffers()[1], np.int64)[found.offset : found.offset + len(found) + 1]
                flat = np.frombuffer(found.buffers()[2], np.uint8)[bounds[0] : bounds[-1]].view("<u4").astype(kind)
                starts = np.concatenate([starts, len(held) + (bounds[:-1] - bounds[0]) // 4])
                ids_of += batch.column(0).slice(at, len(texts)).to_pylist()
                held = np.concatenate([held, flat])
                at += len(texts)
                if n := len(held) // size:
                    yield rows(n)
                    first = int(np.searchsorted(starts, n * size, "right")) - 1
                    starts, ids_of, held = starts[first:] - n * size, ids_of[first:], held[n * size :]
        if len(held):
            yield rows(1)

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"first_doc_id {doc_id}, first_at bigint, n_tokens bigint, ids_crc32 bigint, ids binary"), width


def slots(index: Column, n: int, key: str) -> Column:
    """Training slot of sequence ``index`` of 0 .. n-1."""
    return permute_index(index, n, key, F.lit("training order"))


def write_shards(docs: DataFrame, model: str, folder: str, key: str, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, waves: int = WAVES) -> tuple[DataFrame, Layout]:
    """Write all sequences of ``docs`` (doc_id, text) below ``folder``, and tell where each is.

    Returns one row for each sequence (slot, shard, byte_offset, first_doc_id, first_at,
    n_tokens, ids_crc32) and the layout.  The shards are written in ``waves``, a run of shards
    in each, below ``first=`` and the run's first shard, so that only a part of all ids
    stands in shuffle files at a time.  Without rows there are no sequences and no files.

    A null or empty text has its begin and end ids only, a text longer than a sequence goes
    on in the next ones, and repeated rows and doc_ids are documents like any other; columns
    besides doc_id and text are not read.  ``folder`` must not hold shards yet: a write that
    broke off is done again in another folder, as the order of sequences is the run's own.
    """
    packed, width = pack(docs, model, length)
    end = int(chunk_table(model).sp.eos_id()).to_bytes(width, "little")
    if max(end) > 0x7F:
        raise ValueError("the end id must consist of bytes below 128, as it is written as a separator")
    # encoded once: what follows reads this table, also after an executor is lost
    kept = materialise(packed.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "sequences", level=1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = kept.groupBy("part").agg(F.count("*").alias("n"))  # a row for each task of the encoding
    starts = materialise(parts.select("part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "starts")
    n = starts.agg(F.sum("n")).first()[0] or 0
    layout = Layout(folder, n, length, width, max(1, shard_bytes // (length * width)))

    def place(rows: DataFrame, starts: DataFrame) -> DataFrame:
        slot = slots(F.col("start") + F.col("at"), max(1, n), key)
        return rows.join(F.broadcast(starts.select("part", "start")), "part").withColumn("slot", slot).withColumn("shard", (F.col("slot") / layout.shard_rows).cast("int"))

    if n:
        shards = math.ceil(n / layout.shard_rows)
        # a session of its own, in which a wave's shuffle files go when it has been written
        own = docs.sparkSession.newSession()
        own.conf.set(_CLEANUP, "true")
        ordered = place(reread(kept, own), reread(starts, own))
        for wave in range(min(waves, shards)):
            first, last = shards * wave // min(waves, shards), shards * (wave + 1) // min(waves, shards)
            part = ordered.where(F.col("shard").between(first, last - 1)).select("slot", (F.col("shard") - first).alias("place"), "ids")
            dealt = part.repartitionById(last - first, "place").sortWithinPartitions("slot")
            dealt.select(F.col("ids").cast("string").alias("value")).write.option("lineSep", end.decode("ascii")).text(f"{folder}/first={first:08d}")
    told = place(kept, starts).select(
        "slot",
        "shard",
        ((F.col("slot") % layout.shard_rows) * layout.stride).alias("byte_offset"),
        "first_doc_id",
        "first_at",
        "n_tokens",
        "ids_crc32",
    )
    return told, layout


def read_table(spark: SparkSession, layout: Layout) -> DataFrame:
    """(slot, ids) of all records, wherever the folder lies; a task reads one shard at a time.

    ids are the record's bytes, the end id included.  A filter on ``first``, the first shard
    of the run a record belongs to, leaves out whole runs before they are read.
    """
    if not layout.sequences:
        return spark.createDataFrame([], "first int, slot bigint, ids binary")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(layout.folder)
    shard = F.col("first").cast("int") + F.regexp_extract("path", r"part-([0-9]+)[^/]*$", 1).cast("int")
    last = (F.col("length") / layout.stride).cast("int") - 1
    records = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring("content", (i * layout.stride + 1).cast("int"), F.lit(layout.stride)))
    rows = files.select(F.col("first").cast("int").alias("first"), shard.alias("shard"), F.posexplode(records).alias("row", "ids"))
    return rows.select("first", (F.col("shard").cast("long") * layout.shard_rows + F.col("row")).alias("slot"), "ids")


def read_slots(layout: Layout, start: int = 0, count: int | None = None) -> Iterator[np.ndarray]:
    """Records from slot ``start`` on, from a folder that this machine sees; one open file at a time."""
    if not layout.sequences:
        return
    root = layout.folder.removeprefix("file:")
    by_shard = {}
    for run in os.listdir(root):
        first = int(run.split("=")[1]) if run.startswith("first=") else None
        for f in os.listdir(os.path.join(root, run)) if first is not None else ():
            if f.startswith("part-"):
                by_shard[first + int(f.split("-")[1])] = os.path.join(root, run, f)
    stop = layout.sequences if count is None else min(layout.sequences, start + count)
    at = start
    while at < stop:
        shard, row = divmod(at, layout.shard_rows)
        with open(by_shard[shard], "rb") as f:
            f.seek(row * layout.stride)
            while at < stop and at // layout.shard_rows == shard:
                yield np.frombuffer(f.read(layout.stride), f"<u{layout.width}")
                at += 1
