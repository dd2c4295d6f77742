"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a min-aggregate per node plus a join, so no neighbourhood is collected; every
round's edges are written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thawline.llm.common import saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    out = both.join(low, "u").where("v > u")
    return out.select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    out = down.join(low, "u")
    kept = out.select(F.col("m").alias("a"), F.col("v").alias("b")).union(low.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return kept.where("a <> b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a bigint, b bigint); component = smallest node.

    Self loops and repeated edges do no harm; nodes without an edge are not listed.  An empty
    edge table gives an empty result.
    """
    cur = saved(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "cc")
    before = None
    for _ in range(max_rounds):
        mark = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        cur = saved(_small_star(_large_star(cur)), "cc")
    else:
        raise RuntimeError("components did not converge")
    return cur.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        cur.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
