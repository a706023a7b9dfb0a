"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlens.session import materialize


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root for every node of ``edges`` (u, v: long); nodes of one component share a root, one of them.

    Each round merges every node into the neighbour (or itself) that comes first in a hashed order and renames the edges' ends;
    edges inside a merged node go. Stars vanish in one round, and the hashed order leaves a fixed share of the nodes of any
    shape, so the rounds grow with the logarithm of the longest component. A node's neighbours are met by a minimum only.
    """
    now = materialize(edges.filter("u != v").select("u", "v"))
    labels = now.select(F.col("u").alias("node"), F.col("u").alias("root")).limit(0)
    for k in range(rounds):
        if now.isEmpty():
            return labels
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = F.min(F.struct(F.xxhash64("v").alias("h"), F.col("v").alias("v"))).alias("m")
        own = F.struct(F.xxhash64("u").alias("h"), F.col("u").alias("v"))
        into = materialize(both.groupBy("u").agg(first).select(F.col("u").alias("from"), F.least(F.col("m"), own)["v"].alias("to")))
        if k == 0:
            labels = into.select(F.col("from").alias("node"), F.col("to").alias("root"))
        else:
            labels = materialize(labels.join(into, F.col("root") == F.col("from"), "left").select("node", F.coalesce("to", "root").alias("root")))
        moved = now.join(into, F.col("u") == F.col("from")).select(F.col("to").alias("u"), "v")
        moved = moved.join(into, F.col("v") == F.col("from")).select("u", F.col("to").alias("v"))
        now = materialize(moved.filter("u != v"))
    raise RuntimeError(f"components: not settled after {rounds} rounds")
