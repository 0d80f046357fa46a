"""Connected components of a link table by alternating star contractions.

Each round points every node at the smallest node it sees (large star: its larger neighbours;
small star: its smaller neighbours).  Both steps are a min-aggregation plus a join, so a node with
very many links is combined map-side and never gathered in one task.  Rounds are written with
checkpoint() to the shared folder; the loop ends when a round changes no link.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b: long): root is the smallest node it reaches.

    Null ends and self-links are ignored; an empty table gives an empty result.
    """
    edges = links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    mark = _mark(edges)
    while True:
        # large star: all neighbours above u, and u itself, point at the least of u's neighbourhood
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours point at the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        edges = small.checkpoint()
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """Count and an order-free hash sum of the links: equal for equal sets."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h
