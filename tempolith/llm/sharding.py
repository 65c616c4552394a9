"""Sharding by balanced label propagation, in DataFrame operations only.

Documents with equal texts are linked.  Every document starts in a shard by its id; in
each round the linked ones want to join the shard where most of their neighbours are, and
a matrix of quotas lets as many move from one shard to another as come back or as there
is room for.  A last step makes the sizes even to one row: what exceeds a shard's quota,
and the documents without links, fill the free places in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import materialise, release

SHARDS = 8
ROUNDS = 6
_GRAIN = 1 << 20


def numbered(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """``df`` with ``position``, gapless from 0 in the order given.

    Rows are dealt out by range, so that equal leading keys spread over partitions; only a
    count for each partition is summed up in one place.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = ranged.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
    kept = materialise(ranged, label)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept.groupBy("__part").agg(F.count("*").alias("n")).select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    return kept.join(F.broadcast(starts), "__part").withColumn("position", F.col("__start") + F.col("__at")).drop("__part", "__at", "__start")


def quotas(wanted: dict[tuple[int, int], int], load: list[int], room: int) -> dict[tuple[int, int], float]:
    """Share of the wishes to go from one shard to another that may be met.

    Swaps are always met.  What is left goes where a shard holds fewer than ``room`` linked
    rows, first to the shards with most free places.
    """
    met = {(s, t): min(n, wanted.get((t, s), 0)) for (s, t), n in wanted.items()}
    free = [max(0, room - x) for x in load]
    for (s, t), n in sorted(wanted.items(), key=lambda x: (-free[x[0][1]], x[0])):
        more = min(n - met[s, t], free[t])
        met[s, t] += more
        free[t] -= more
        free[s] += more
    return {k: met[k] / n for k, n in wanted.items() if n}


def propagate(linked: DataFrame, shards: int, room: int, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, g, shard) after some rounds of label propagation under quotas.

    ``linked`` (doc_id, key, g, shard) is a table of ``materialise`` and is used up.  Only a
    matrix of shards by shards reaches the driver.  Whole groups move together by
    their own draw, but the rows of a group larger than a sixteenth of a shard draw singly.
    """
    for i in range(rounds):
        counts = materialise(linked.groupBy("g", "shard").agg(F.count("*").alias("n")), "labels")
        load = [0] * shards
        for r in counts.groupBy("shard").agg(F.sum("n").alias("n")).collect():
            load[r["shard"]] = r["n"]
        # at first the shard with most neighbours; what finds it full goes on to the best one with room
        full = [s for s in range(shards) if load[s] >= room] if i else []
        size = counts.groupBy("g").agg(F.sum("n").alias("size"))
        best = F.max(F.struct("n", F.xxhash64("g", "shard").alias("tie"), F.col("shard").alias("target")))
        target = counts.where(~F.col("shard").isin(full)).groupBy("g").agg(best.alias("best")).select("g", "best.*")
        target = materialise(target.withColumnRenamed("n", "there").join(size, "g"), "targets")
        wish = counts.join(target, "g").where((F.col("shard") != F.col("target")) & (F.struct("n", F.xxhash64("g", "shard").alias("tie")) < F.struct(F.col("there").alias("n"), "tie")))
        wish = materialise(wish.select("g", "shard", "target", "size", "n"), "wishes")
        moves = wish.groupBy("shard", "target").agg(F.sum("n").alias("n")).collect()
        wanted = {(r["shard"], r["target"]): r["n"] for r in moves}
        release(counts, target)
        if not wanted:
            release(wish)
            break
        share = quotas(wanted, load, room)
        rate = F.create_map(*(F.lit(x) for (s, t), v in sorted(share.items()) for x in (s * shards + t, float(v))))
        alone = F.xxhash64(F.when(F.col("size") > room / 16, F.col("doc_id")), "g", F.lit(i))
        drawn = F.pmod(alone, F.lit(_GRAIN)) / _GRAIN
        goes = drawn < F.coalesce(F.try_element_at(rate, F.col("shard") * shards + F.col("target")), F.lit(0.0))
        joined = linked.join(wish.drop("n"), ["g", "shard"], "left")
        moved = materialise(joined.select("doc_id", "key", "g", F.when(goes, F.col("target")).otherwise(F.col("shard")).alias("shard")), "shards")
        release(linked, wish)
        linked = moved
    return linked


def _pick(values: list[int], at: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v).cast("bigint") for v in values)), at + 1)


def assign(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot for every row of ``docs`` (doc_id, text).

    Shards hold as many rows as each other, or one more in the first ones.  size is the
    text's UTF-8 bytes plus 1; a null text counts as empty.  slot is gapless from 0 in each
    shard.  Rows without doc_id, repeated doc_ids and repeated rows are rows like any other,
    and a text of any length counts as one; ties are broken by hashes and by the row's place.
    Other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text, F.octet_length(text)).alias("g"),
    )
    base = base.withColumn("key", F.monotonically_increasing_id())
    base = materialise(base.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")), "base")
    groups = materialise(base.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g"), "groups")
    total = base.count()
    linked = materialise(base.join(groups, "g", "left_semi").select("doc_id", "key", "g", "shard"), "linked")
    release(groups)
    linked = propagate(linked, shards, total // shards, rounds)
    placed = base.drop("shard").join(linked.select("key", "shard"), "key", "left").withColumn("label", F.coalesce("shard", F.lit(shards)))
    rows = numbered(placed.select("doc_id", "size", "text_crc32", "label", "g", "key"), ["label", "g", "doc_id", "key"], "placed")
    sizes = {r["shard"]: r["n"] for r in linked.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    load = [sizes.get(s, 0) for s in range(shards)]
    room = [total // shards + (s < total % shards) for s in range(shards)]
    first = [sum(load[:s]) for s in range(shards + 1)]  # first position of each label
    held = [min(a, b) for a, b in zip(load, room, strict=True)]
    over = [0]
    for a, b in zip(load, held, strict=True):
        over.append(over[-1] + a - b)
    free = [0]
    for a, b in zip(room, held, strict=True):
        free.append(free[-1] + a - b)
    label = F.col("label")
    rank = F.col("position") - _pick(first, label)
    stays = (label < shards) & (rank < _pick([*held, 0], label))
    # the place among those that fill free places: what exceeds its shard, then documents without links
    spare = F.when(label < shards, _pick(over, label) + rank - _pick([*held, 0], label)).otherwise(over[-1] + rank)
    into = F.lit(0)
    for s in range(1, shards):
        into = F.when(F.col("spare") >= free[s], s).otherwise(into)
    out = rows.withColumns({"rank": rank, "stays": stays, "spare": spare}).withColumn("into", into)
    shard = F.when(F.col("stays"), label).otherwise(F.col("into")).cast("int")
    slot = F.when(F.col("stays"), F.col("rank")).otherwise(_pick(held, F.col("into")) + F.col("spare") - _pick(free[:-1], F.col("into")))
    return out.select("doc_id", "size", "text_crc32", shard.alias("shard"), slot.cast("long").alias("slot"))


def shard_documents(docs: DataFrame) -> DataFrame:
    """The contract's columns: counts at most one apart, so no shard grows by key."""
    return assign(docs).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
