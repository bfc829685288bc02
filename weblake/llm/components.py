"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is one aggregation and one join on a slim (node, node) table; the edges are
staged as a table after every round, so a lost executor costs a reread and the plan
never grows. The aggregated side of a join is staged too: both sides then come straight from an
exchange, and adaptive execution can split a hub (the leader of a large group of copies).
Nothing is collected but two numbers a round (edge count and a checksum).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 30))).first()
    return row[0], row[1]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns ``node``, ``component`` (its smallest reachable node) for every node on a link.

    Self-links and repeated links are harmless; an empty table gives no rows.
    """
    edges = (links.where(F.col(a) != F.col(b))
             .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    edges = stage(edges, "edges")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = stage(large, "large")
        low = stage(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = (large.join(low, "u").where("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                     low.select("u", F.col("m").alias("v"))).distinct())
        edges = stage(small, "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")))
            .groupBy("node").agg(F.min("component").alias("component")))
