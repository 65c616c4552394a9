"""Writers: one file for each document, one JSON file for a corpus, plain tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_path(patient_id: str, doc_id: str, suffix: str, form: str) -> str:
    return f"{patient_id}/{doc_id}_{suffix}.{form}"


def write_documents(tables: DataFrame, folder: str, suffix: str, form: str) -> DataFrame:
    """Write the content of each document below ``folder``, by patient; returns nothing but the frame of paths.

    The executors write, each file by a rename, so a repeated task leaves the same files.
    ``folder`` must be a mount that all executors and the driver share; ``write_tables``
    writes a corpus's tables on any file system.
    """
    import os
    from collections.abc import Iterator

    import pandas as pd

    root = folder.removeprefix("file:")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            paths = [os.path.join(root, table_path(p, d, suffix, form)) for p, d in zip(frame["patient_id"], frame["doc_id"], strict=True)]
            for path, text in zip(paths, frame["content"], strict=True):
                os.makedirs(os.path.dirname(path), exist_ok=True)
                part = f"{path}.{uuid.uuid4().hex}"
                with open(part, "w", encoding="utf-8", newline="") as f:
                    f.write(text)
                os.replace(part, path)
            yield pd.DataFrame({"path": paths})

    return tables.select("patient_id", "doc_id", "content").mapInPandas(run, "path string")


def keeper(folder: str) -> Callable[[DataFrame, str], DataFrame]:
    """A function that stores a table under its name in a folder and reads it from there."""

    def keep(table: DataFrame, name: str) -> DataFrame:
        table.write.mode("overwrite").parquet(f"{folder}/{name}")
        return table.sparkSession.read.schema(table.schema).parquet(f"{folder}/{name}")

    return keep


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on any Hadoop file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_tables(rows: DataFrame, folder: str, columns: list[str], sep: str = "|") -> None:
    """One separated table for the corpus, written in parallel."""
    rows.select(*columns).write.option("sep", sep).option("header", True).option("emptyValue", "").csv(folder)


def corpus_json(entries: DataFrame) -> DataFrame:
    """Lines of a corpus's JSON object, sorted by patient: (patient_id, line) for each patient."""
    inner = F.array_join(F.transform("entries", lambda e: F.concat(F.lit("    ["), F.array_join(F.transform(e, _json_string), ", "), F.lit("]"))), ",\n")
    body = F.when(F.size("entries") == 0, F.lit("[]")).otherwise(F.concat(F.lit("[\n"), inner, F.lit("\n  ]")))
    return entries.select("patient_id", F.concat(F.lit("  "), _json_string(F.col("patient_id")), F.lit(": "), body).alias("line"))


def _json_string(c):
    """A string as JSON spells it."""
    packed = F.to_json(F.array(c))
    return F.substring(packed, F.lit(2), F.length(packed) - 2)


def write_corpus_json(entries: DataFrame, path: str) -> None:
    """One JSON file for a corpus, on any Hadoop file system.

    Spark sorts the patients by range and writes their lines in parallel; the parts are then
    copied one behind the other, as bytes, so the driver holds a buffer and no rows.
    """
    spark = entries.sparkSession
    lines = corpus_json(entries)
    last = entries.agg(F.max("patient_id")).first()[0]
    ended = lines.select("patient_id", F.concat("line", F.when(F.col("patient_id") < last, ",").otherwise("")).alias("value"))
    parts = f"{path}.{uuid.uuid4().hex}.parts"
    ended.repartitionByRange("patient_id").sortWithinPartitions("patient_id").select("value").write.text(parts)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target, source = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, parts))
    fs = target.getFileSystem(conf)
    fs.setWriteChecksum(False)
    out = fs.create(target, True)
    try:
        out.write(bytearray(b"{\n"))
        for part in sorted(str(f.getPath()) for f in fs.listStatus(source) if f.getPath().getName().startswith("part-")):
            read = fs.open(jvm.org.apache.hadoop.fs.Path(part))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(read, out, 1 << 16, False)
            finally:
                read.close()
        out.write(bytearray(b"}\n"))
    finally:
        out.close()
        fs.setWriteChecksum(True)
    remove(spark, parts)
