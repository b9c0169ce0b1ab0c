"""Connected components over a table of edges, by alternating large-star and small-star steps.

Every step is a minimum per vertex (combined before the shuffle) and a join back, so a vertex with very many
neighbours never gathers them in one task. The edges of a step are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v) with u > v. large: each greater neighbour of a vertex is linked to the least vertex around it;
    small: each vertex's smaller neighbours, and itself, are."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        linked = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        linked = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return linked.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every vertex with an edge but the roots; root is the least vertex of its component.

    edges: two columns u, v of one orderable type, any direction, repeats and loops allowed.
    """
    now = written(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "edges"
    )
    mark = None
    while True:
        now = written(_star(_star(now, True), False), "edges")
        seen = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if seen == mark:
            break
        mark = seen
    return now.select("u", F.col("v").alias("root"))
