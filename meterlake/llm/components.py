"""Connected components of an edge table, without moving it to the driver.

Alternating star contraction: in turn every node hangs its larger and its smaller neighbours under its least neighbour.  The
minimum of a node is aggregated before it is joined back, so that a node of any degree is split over tasks; the number of
rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.sources.staging import stage


def _contract(edges: DataFrame, larger: bool) -> DataFrame:
    """edges (u, v), u > v.  larger: larger neighbours move; else the node and its smaller neighbours do."""
    if larger:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        moved = near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.distinct()


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) for every node of the edges (a, b); self-loops and repeated edges do no harm."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = stage(now, "edges")
    seen = _print(now)
    while seen[0]:
        now = stage(_contract(_contract(now, True), False), "edges")
        before, seen = seen, _print(now)
        if seen == before:
            break
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
