"""Connected components of an edge table, without collecting nodes, edges or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import spread_join, staged


def _marked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    edges = staged(edges, "edges")
    return edges, tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) of every node of edges (u, v: long).  Alternates large-star and
    small-star steps until the edges stand still; each is one grouped minimum and one join, and every round is staged.  The hubs of
    large stars are joined by broadcast, so no task gets all edges of one node."""
    both = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, mark = _marked(both)
    while mark[0]:
        around = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("k")).select("u", F.least("u", "m").alias("m"), "k")
        large = spread_join(around.filter("v > u"), least, "u", 2 * mark[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("k"))
        joined = spread_join(large, least, "u", 2 * mark[0])
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        now, new_mark = _marked(small)
        if new_mark == mark:
            break
        mark = new_mark
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
