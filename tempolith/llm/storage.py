"""Tables that cut lineage, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder of this application below ``spark.checkpoint.dir``.

    Only where that setting is absent (tests, a laptop) a temporary folder takes
    its place; in local mode the driver is the only machine.
    """
    app = spark.sparkContext.applicationId
    if app not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="tempolith-")
        _roots[app] = f"{base.rstrip('/')}/tempolith-{app}"
        atexit.register(_remove, spark, _roots[app])
    return _roots[app]


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None and spark.sparkContext._jvm is not None:
        delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder through Hadoop's file system, wherever it lies."""
    try:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  the session has ended: what is left goes with the checkpoint folder
        pass


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, level: int = 3) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back; ``level`` is zstd's.

    Unlike a local checkpoint the files outlive any executor; unlike a cache they
    cost no executor memory.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._tempolith_path = path
    return table


def reread(table: DataFrame, spark: SparkSession) -> DataFrame:
    """A table of ``materialise`` in another session of the same application."""
    return spark.read.schema(table.schema).parquet(table._tempolith_path)


def release(*tables: DataFrame) -> None:
    """Delete tables of ``materialise`` that nothing will read again, lazily or after a loss."""
    for table in tables:
        delete(table.sparkSession, table._tempolith_path)


def quoted(names: Iterable[str]) -> list[str]:
    """Column names that may hold dots."""
    return ["`" + c.replace("`", "``") + "`" for c in names]


def unused(name: str, taken: Iterable[str]) -> str:
    """``name``, or a longer one that none of ``taken`` equals, letter case apart."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def text_key(text: Column) -> Column:
    """SHA-256 of a text, null as the empty one."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and any others) without the rows whose id and text ``gone`` (of, text_key) names.

    Rows whose doc_id isn't named at all, nearly all as a rule, are told by their id, a column
    that is small to send; the others are then told by id and text.  Both joins deal the rows
    out alike, so where they are shuffled it is done once.  A row without doc_id stays.
    """
    gone = materialise(gone, "gone")
    ids = materialise(gone.select("of").distinct(), "ids")  # a table, whose size tells the join whether it may be sent out
    key, columns = unused("__key", docs.columns), quoted(docs.columns)
    here = docs["doc_id"] == ids["of"]
    named = docs.join(ids, here, "left_semi").withColumn(key, text_key(F.col("text")))
    others = named.join(gone, (named[key] == gone["text_key"]) & (named["doc_id"] == gone["of"]), "left_anti")
    return docs.join(ids, here, "left_anti").select(columns).union(others.select(columns))


def mapped(docs: DataFrame, keep: Iterable[str], value: Column, run: Callable, added: dict[str, str]) -> DataFrame:
    """``keep`` columns of any name, and columns ``added`` (name: type) that ``run`` makes of ``value``.

    ``run`` maps Arrow batches whose last column is ``value`` to batches with the added
    columns in its place.
    """
    keep = list(keep)
    if clash := set(keep) & set(added):
        raise ValueError(f"kept columns {sorted(clash)} need other names for the results")
    # under plain names, as a map over batches finds no column with a dot in its name
    source = docs.select(*(F.col(name).alias(f"kept{i}") for i, name in enumerate(quoted(keep))), value.alias("value"))
    out = [f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    return source.mapInArrow(run, ", ".join([*out, *(f"`{n}` {t}" for n, t in added.items())])).toDF(*keep, *added)
