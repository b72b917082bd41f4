"""Connected components by alternating large and small stars.

Every round links nodes straight to the smallest neighbour they know of; the
number of rounds grows with the logarithm of the longest chain.  Each round is
written to the shared folder, so its lineage stays short and a lost executor
costs no more than one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.frames import written


def _smallest(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the smallest of u and all its v."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = _smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    near = _smallest(edges)
    linked = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        near.select("u", F.col("m").alias("v"))
    )
    return linked.filter("u <> v").distinct()


def connected(pairs: DataFrame, label: str = "components") -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, of all nodes in ``pairs``.

    ``pairs`` has two columns of nodes; pairs with a null and pairs of a node with
    itself link nothing.  The smallest node of each component is listed too.
    """
    one, other = (F.col(name) for name in pairs.columns)
    edges = written(
        pairs.select(F.greatest(one, other).alias("u"), F.least(one, other).alias("v"))
        .filter(one.isNotNull() & other.isNotNull() & (one != other))
        .distinct(),
        label,
    )
    state = None
    while True:
        edges = written(_small_star(_large_star(edges)), label)
        mark = F.struct(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")))
        now = edges.agg(mark).first()[0]
        if now == state:
            break
        state = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select("v", "v").distinct())
