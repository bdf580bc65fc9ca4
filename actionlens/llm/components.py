"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actionlens.llm.common import pin, unpin


def _least(pairs: DataFrame) -> DataFrame:
    """For (u, v): u and the least of u and its v's; written, so that both sides of the join are dealt anew and a hot u can be split."""
    return pin(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "stars")


def _large_star(edges: DataFrame) -> DataFrame:
    """Written; ``edges`` are read no more."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both)
    out = pin(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "edges")
    unpin(least, edges)
    return out


def _small_star(edges: DataFrame) -> DataFrame:
    """Written; ``edges`` are read no more."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    least = _least(down)
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = pin(moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
    unpin(least, edges)
    return out


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of an edge (columns u, v) and the least node of its component.

    Each round lets every node point its larger, then its smaller neighbours to the least one it
    knows; rows never outnumber the edges, and rounds grow with the logarithm of a component's width.
    """
    state, before = pin(edges.select("u", "v").where("u <> v").distinct(), "edges"), None
    while True:
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
        state = _small_star(_large_star(state))
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
