"""Connected components by alternating large-star and small-star steps.

Late rounds are stars: nearly every node of a large component is a neighbour of
its least one.  A node's least neighbour is found with partial minima.  For nodes with
many edges it is broadcast, and their edges are dealt over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import cut_lineage
from .lookups import HOT_ROWS, HOT_SHARE


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Written edges with their number and content hash.

    Both are observed while the rows are written; equal values from one round
    to the next mean nothing moved.
    """
    seen = Observation()
    content = F.sum(F.xxhash64("g", "u", "v").cast("decimal(38,0)"))
    written = cut_lineage(
        edges.observe(seen, F.count(F.lit(1)).alias("n"), content.alias("content"))
    )
    return written, (seen.get["n"], seen.get["content"])


def _with_least(edges: DataFrame, least: DataFrame, n: int) -> DataFrame:
    """Edges (g, u, v) with the value `m` that `least` has for (g, u).

    `degree` of `least` is how many of the n edges a node has.  Nodes with more
    than a ten-thousandth of them number at most ten thousand and are broadcast;
    their edges go through the join under keys of their own, and what these may
    meet there is ignored.
    """
    limit = max(HOT_ROWS, int(n * HOT_SHARE))
    hubs = least.filter(F.col("degree") > limit).select("g", "u", F.col("m").alias("hub"))
    kind = dict(edges.dtypes)["u"]
    key = F.when(F.col("hub").isNull(), F.col("u")).otherwise(F.xxhash64("u", "v").cast(kind))
    marked = edges.join(F.broadcast(hubs), ["g", "u"], "left").withColumn("key", key)
    others = least.select(F.col("g").alias("of"), F.col("u").alias("node"), "m")
    return marked.join(
        others, (F.col("g") == F.col("of")) & (F.col("key") == F.col("node")), "left"
    ).select("g", "u", "v", F.coalesce("hub", "m").alias("m"))


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.unionByName(edges.select("g", F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("g", "u").agg(
        F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("degree")
    )
    return (
        _with_least(both.filter(F.col("v") > F.col("u")), least, 2 * n)
        .select("g", F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    down = edges.select(
        "g", F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).filter(F.col("u") != F.col("v"))
    least = down.groupBy("g", "u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree"))
    linked = _with_least(down, least, n).select("g", F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("g", "u", F.col("m").alias("v"))
    return linked.unionByName(own).filter(F.col("u") != F.col("v")).distinct()


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(g, node) -> smallest node of its component, for many graphs g at once.

    The number of rounds grows with the logarithm of the graph, not with its
    diameter.  Every round is written to the checkpoint folder, so the plan
    stays short and a lost executor costs at most one round.
    """
    current, state = _settled(
        edges.select("g", F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter(F.col("u") != F.col("v"))
        .distinct()
    )
    while state[0]:
        before = state
        # a large star has no more edges than there are, so n bounds both steps
        current, state = _settled(_small_star(_large_star(current, state[0]), state[0]))
        if state == before:
            break
    root = current.groupBy("g", F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return nodes.join(root, ["g", "node"], "left").select(
        "g", "node", F.coalesce("root", "node").alias("component")
    )
