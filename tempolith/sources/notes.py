"""Sources: folders of notes, prompts, recorded model outputs."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from ..schemas import RECORDED

#: Spark passes over files of no bytes, so a note has at least one
_OPTIONS = {"recursiveFileLookup": "true", "pathGlobFilter": "*.txt"}
_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
#: what opening a note counts beside its length when files are dealt out to tasks; Spark's 4 MB put a few notes into each task
_OPEN_COST = 32 << 10
#: so many notes are listed by Spark's reader, whose driver holds about a KB for each until the plan is gone
_LISTED = 20_000
#: bytes of notes that a task hands over at once
_BATCH = 8 << 20


def _named(files: DataFrame, corpus: str) -> DataFrame:
    path = F.col("path")
    return files.select(
        F.lit(corpus).alias("corpus"),
        _decoded(F.regexp_extract(path, "([^/]+)/[^/]+$", 1)).alias("patient_id"),
        _decoded(F.regexp_extract(path, r"([^/]+)\.txt$", 1)).alias("doc_id"),
        path,
        F.col("modificationTime").alias("mtime"),
        F.make_valid_utf8(F.col("content").cast("string")).alias("text"),
    )


def _decoded(name: Column) -> Column:
    """A path component as it was before it became part of a URI."""
    return F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)


def corpus_name(folder: str) -> str:
    return folder.rstrip("/").rsplit("/", 1)[-1].strip() or "Corpus not set"


def read_notes(spark: SparkSession, folder: str, most_listed: int = _LISTED) -> DataFrame:
    """(corpus, patient_id, doc_id, path, mtime, text): one row for each ``patient/doc.txt`` below a folder.

    Up to ``most_listed`` notes go through Spark's reader.  More, below a mount that all executors share, are
    listed and read by tasks, each time the frame is run: their list is a table and the driver knows its length only.  On
    other file systems Spark's reader takes all, and its driver holds the list.
    """
    local = _mounted(spark, folder)
    if local is not None:
        files = _listed(spark, local)
        n, size = files.agg(F.count("*"), F.sum("length")).first()
        if n > most_listed:
            return _named(_read(files, n, size), corpus_name(folder))
    return _named(_loaded(spark, folder), corpus_name(folder))


def _loaded(spark: SparkSession, folder: str) -> DataFrame:
    """The files as Spark's own reader lists and reads them.

    Spark's executors list the files where a folder has more than 32 others in it, as most have with one for
    each patient.  How files are dealt out is a setting of the session that loads them, so they are
    loaded in one of their own; the empty frame before them, which no plan keeps, brings the rows back into the caller's.
    """
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.files."):
            own.conf.set(name, value)
    own.conf.set("spark.sql.files.openCostInBytes", _OPEN_COST)
    notes = own.read.format("binaryFile").options(**_OPTIONS).load(folder)
    return spark.createDataFrame([], notes.schema).limit(0).union(notes)


def _mounted(spark: SparkSession, folder: str) -> str | None:
    """The folder's path where it is a mounted one, else nothing: another file system, a pattern, or no folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    return uri.getPath() if uri.getScheme() == "file" and os.path.isdir(uri.getPath()) else None


def _hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _entries(folder: str) -> Iterator[tuple[str, bool, int, int]]:
    """(path, whether it is a folder, bytes, milliseconds of its last change) of what notes may be or lie in."""
    with os.scandir(folder) as found:
        for x in found:
            if _hidden(x.name):
                continue
            if x.is_dir():
                yield x.path, True, 0, 0
            elif x.name.endswith(".txt") and (now := x.stat()).st_size:
                yield x.path, False, now.st_size, now.st_mtime_ns // 1_000_000


def _below(folder: str) -> Iterator[tuple[str, bool, int, int]]:
    """All notes below a folder."""
    open_ = [folder]
    while open_:
        for x in _entries(open_.pop()):
            if x[1]:
                open_.append(x[0])
            else:
                yield x


def _listed(spark: SparkSession, root: str) -> DataFrame:
    """(path, folder, length, changed) of all notes below a folder; what lies two levels down is dealt out to tasks."""
    schema = "path string, folder boolean, length bigint, changed bigint"
    names = ["path", "folder", "length", "changed"]

    def opened(look):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                rows: list[tuple] = []
                for row in frame.itertuples(index=False):
                    for x in look(row.path) if row.folder else [tuple(row)]:
                        rows.append(x)
                        if len(rows) >= 10_000:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                yield pd.DataFrame(rows, columns=names)

        return run

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = spark.range(0, 1, 1, 1).select(F.lit(root).alias("path"), F.lit(True).alias("folder"), F.lit(0).cast("long").alias("length"), F.lit(0).cast("long").alias("changed"))
    for look in (_entries, _entries, _below):
        files = files.mapInPandas(opened(look), schema)
        files = files if look is _below else files.repartition(parts, "path")
    return files


def _read(files: DataFrame, n: int, size: int) -> DataFrame:
    """The listed files with their content, as Spark's reader gives them, dealt out by their number and length."""
    spark = files.sparkSession
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    tasks = max(spark.sparkContext.defaultParallelism, -(-(size + n * _OPEN_COST) // most))
    pass_over = spark.conf.get("spark.sql.files.ignoreMissingFiles") == "true"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows: list[tuple] = []
            held = 0
            for path, changed in zip(frame["path"], frame["changed"], strict=True):
                try:
                    with open(path, "rb") as f:
                        content = f.read()
                except FileNotFoundError:
                    if pass_over:
                        continue
                    raise
                rows.append((f"file:{path}", changed, len(content), content))
                held += len(content)
                if held >= _BATCH:
                    yield pd.DataFrame(rows, columns=["path", "changed", "length", "content"])
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=["path", "changed", "length", "content"])

    found = files.repartition(tasks, "path").mapInPandas(run, "path string, changed bigint, length bigint, content binary")
    return found.select("path", F.timestamp_millis("changed").alias("modificationTime"), "length", "content")


def stream_notes(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """The same as a stream; ``files_per_batch`` holds back what comes in faster than it is worked off."""
    reader: DataStreamReader = spark.readStream.format("binaryFile").options(**_OPTIONS).option("maxFilesPerTrigger", files_per_batch).schema(_SCHEMA)
    return _named(reader.load(folder), corpus_name(folder))


def read_prompt(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def read_recorded(spark: SparkSession, path: str) -> DataFrame:
    """Recorded model outputs, a JSON line for each section."""
    return spark.read.schema(RECORDED).json(path)
