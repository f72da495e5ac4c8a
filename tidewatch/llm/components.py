"""Connected components by alternating large-star and small-star steps.

Each step is two partially aggregated shuffles over the edge table, which is
written to the shared folder, so that neither lineage nor driver state grows
with the number of steps.  No group of neighbours is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import materialise, remove


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"),
                           F.sum(F.hash("u", "v").cast("long"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph.

    ``edges``: two columns of one orderable type (self-links and repeats do no
    harm, nulls are dropped).  Returns ``node, root`` for every node that has a
    link to another one; ``root`` is the least node of its component.  An empty
    table gives an empty result.
    """
    a, b = edges.columns[:2]
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("u <> v").distinct())
    e = materialise(e, "edges")
    before = _state(e)
    while before[0]:
        step = materialise(_small_star(_large_star(e)), "edges")
        remove(e)
        e, after = step, _state(step)
        if after == before:
            break
        before = after
    roots = e.select(F.col("v").alias("node")).distinct()
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(roots.select("node", F.col("node").alias("root"))))
