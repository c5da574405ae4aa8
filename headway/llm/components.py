"""Connected components by alternating large-star and small-star steps.

Every step is a group-by and a join on a node, so a node with very many links is
pre-aggregated and its rows can be dealt out by the skew join; each round is
written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import written


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    root = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(root, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(root.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node in a link (``a``, ``b``) but the roots.

    Links with a null end are ignored, links of a node with itself too; no links
    give no rows.
    """
    ends = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = written(ends.distinct(), "edges")
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
        edges = written(_stars(edges), "edges")
