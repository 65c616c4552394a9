"""Connected components as iterated joins (large star, small star).

Each round attaches every node's larger neighbours, then its smaller ones, to the least
neighbour.  The number of edges never grows and the rounds are logarithmic in the number
of nodes.  Minima are partial aggregates, and the join that hands them out is a plain
equi-join of two tables, which adaptive execution splits where one node holds many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialise, release


def _least(edges: DataFrame, label: str) -> DataFrame:
    return materialise(edges.groupBy("u").agg(F.min("v").alias("m")), label)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst); a component bears its least node.

    Loops and nulls are left out, repeated and reversed edges count once.  No edges, no rows.
    """
    pairs = (
        edges.where("src is not null and dst is not null and src <> dst")
        .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        .distinct()
    )
    pairs = materialise(pairs, "edges")
    for _ in range(max_rounds):
        # done when every edge leads to a node without smaller neighbours, and to one only
        ends = pairs.groupBy("u").agg(F.count("*").alias("n"))
        open_ = pairs.select(F.col("v").alias("u")).distinct().withColumn("end", F.lit(True)).join(ends, "u")
        if ends.where("n > 1").isEmpty() and open_.isEmpty():
            break
        # large star: every edge from both ends
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both, "least")
        ends = least.select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(ends, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialise(large, "large")
        release(pairs, least)
        # small star: u is the greater end of each edge
        least = _least(large, "least")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        own = least.select("u", F.col("m").alias("v"))
        pairs = materialise(small.union(own).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        release(large, least)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
