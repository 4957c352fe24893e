"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citytherm.llm.common import discard, stage


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _to_minimum(directed: DataFrame, only_larger: bool) -> DataFrame:
    """Connect the neighbours of each u to the smallest node near u.  The minimum
    is a grouped aggregate with partial sums per task, and the join back has one
    row per key on that side, so AQE can split a hub with very many neighbours."""
    least = directed.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = directed.join(least, "u")
    if only_larger:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.where("u <> m").select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges(u, v)``; the component is its
    smallest node.  Each round is written to the shared folder, so a later one
    never recomputes it.  The rounds end when every node points at a minimum; if they
    run out before that it is an error, so no link is lost without a word."""
    ordered = (edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    now = stage(ordered, "edges")
    summary = None
    for _ in range(rounds):
        # large star: neighbours above u move to the minimum around u;
        # small star: u's smaller neighbours, and u, move to the least of them
        large = _to_minimum(_both(now), only_larger=True)
        after = stage(_to_minimum(large, only_larger=False), "edges")
        check = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        discard(now)
        now = after
        if check == summary:
            break
        summary = check
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
