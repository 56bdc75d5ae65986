"""Connected components of an edge table, with Spark joins and groupings only.

Alternates the large-star and small-star steps of Kiveris et al. (2014). Each
round is one grouped minimum (combined before its shuffle, so a hub with a
third of all edges leaves every task as one row) and one join that adaptive
execution may split. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cctally.llm.common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over undirected edges ``(u, v)``: neighbours link to the least of each star."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.filter("v < u")
    # written first, so that the join deals its sides anew and adaptive execution can split a hub
    least = stage(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
    linked = both.join(least, "u").select("u", "v", "m")
    if large:
        out = linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)``; the root is the least node.

    Null ends and loops are dropped; an empty edge table gives an empty result.
    """
    now = stage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .distinct(), "edges")
    mark = None
    while True:
        now = stage(_star(_star(now, large=True), large=False), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
