"""Connected components of a link table, on joins and aggregates only.

Alternating large-star and small-star rounds: every round is two grouped
minima and two joins.  Minima are combined before the shuffle and written; the
joins read them with one row per node, and both sides of a join are plain
shuffles, so Spark's skew rule splits the links of a node with very many and they
never meet in one task.  Each round is written to the shared folder, which cuts
the lineage and survives a lost executor; its folder goes when the next is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm.common import discard, written


def _lows(links: DataFrame) -> DataFrame:
    return written(links.groupBy("u").agg(F.min("v").alias("m")), "components-low")


def _large_star(e: DataFrame, low: DataFrame) -> DataFrame:
    """``low``: the written minima of the links in both directions."""
    sym = _both_ways(e)
    return (sym.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())


def _both_ways(e: DataFrame) -> DataFrame:
    return e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _small_star(e: DataFrame, low: DataFrame) -> DataFrame:
    near = e.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _round(e: DataFrame) -> DataFrame:
    low = _lows(_both_ways(e))
    large = written(_large_star(e, low), "components-large")
    discard(low)
    low = _lows(large)
    out = written(_small_star(large, low), "components")
    discard(low)
    discard(large)
    return out


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, v) links -> (node, root): root is the smallest node reachable.

    Nodes without a link are not returned.  Links may repeat, point both ways
    or join a node to itself.  Raises when ``max_rounds`` is not enough (the
    rounds needed grow with the logarithm of the longest chain).
    """
    e = (links.where("u != v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = written(e, "components")
    before = _state(e)
    for _ in range(max_rounds):
        old, e = e, _round(e)
        discard(old)
        after = _state(e)
        if after == before:
            roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
