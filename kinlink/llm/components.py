"""Connected components by alternating large-star and small-star steps.

Every step is an aggregation of minima (combined before its shuffle) and a join
with one row a key on its right side, so a vertex with very many neighbours is
split like any other skewed key and nothing is gathered in one place.  Each round
is a written table, and the rounds end when only stars are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialise


def _stars_only(e: DataFrame) -> bool:
    """Whether every u has one v, and no v is a u."""
    ends = e.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every non-root node of links (a, b); root is the smallest node reachable."""
    e = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = materialise(e, "links")
    while not _stars_only(e):
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialise(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialise(small.union(low).distinct(), "small-star")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
