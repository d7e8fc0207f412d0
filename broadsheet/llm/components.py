"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.operators.skew import skew_lookup
from broadsheet.session import cut


#: A vertex with that many edges has its minimum broadcast (for at most ``skew.MAX_HOT`` vertices), its edges stay spread.
HUB = 1_000


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """``edges`` with ``_m`` of their ``_u``; ``least`` has one row per ``_u`` and the number of its edges, ``_n``."""
    table = least.select(F.col("_u").cast("string").alias("_k"), "_m", "_n")
    return skew_lookup(edges, F.col("_u").cast("string"), F.col("_v"), table, "_k", "_n", HUB)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction. Every vertex links its neighbours (larger ones, or itself and smaller ones) to the
    smallest vertex around it. The minimum is combined before the shuffle, and that of a hub is broadcast back to its
    edges, so a vertex with very many neighbours is never one task's group."""
    if large:
        both = edges.unionByName(edges.select(F.col("_v").alias("_u"), F.col("_u").alias("_v")))
        near = both.groupBy("_u").agg(F.least(F.min("_v"), F.col("_u")).alias("_m"), F.count(F.lit(1)).alias("_n"))
        out = _with_least(both.filter("_v > _u"), near).select(F.col("_v").alias("_u"), F.col("_m").alias("_v"))
    else:
        down = edges.select(F.greatest("_u", "_v").alias("_u"), F.least("_u", "_v").alias("_v"))
        near = down.groupBy("_u").agg(F.min("_v").alias("_m"), F.count(F.lit(1)).alias("_n"))
        linked = _with_least(down, near).select(F.col("_v").alias("_u"), F.col("_m").alias("_v"))
        out = linked.unionByName(near.select("_u", F.col("_m").alias("_v")))
    return out.filter("_u <> _v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Columns node and component (the smallest node reachable) for every node with an edge to another.

    Edges with a null end and loops link nothing. Rounds grow with the logarithm of the longest chain;
    each is written to the shared folder, so a lost executor costs one round at most.
    """
    now = cut(
        edges.select(F.col(a).cast("long").alias("_u"), F.col(b).cast("long").alias("_v")).filter("_u <> _v").distinct(), "edges"
    )

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("_u", "_v") % 1_000_003), F.sum(F.xxhash64("_v", "_u") % 999_983)).first())

    before = state(now)
    while before[0]:
        now = cut(_star(_star(now, large=True), large=False), "edges")
        after = state(now)
        if after == before:
            break
        before = after
    return now.groupBy(F.col("_u").alias("node")).agg(F.min("_v").alias("component")).unionByName(
        now.select(F.col("_v").alias("node"), F.col("_v").alias("component")).distinct()
    )
