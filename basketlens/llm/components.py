"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.sources.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``id``, ``component`` (the smallest id reachable) for every id in ``links`` (``a``, ``b``).

    Each round hangs every id and its larger neighbours below its smallest
    neighbour, then every id's smaller neighbours; the number of rounds grows with the
    logarithm of a component's width.  Only minima are taken per id, with partial sums.
    Every round is written to the shared folder, so a lost executor costs one round.
    """
    edges = cut_lineage(
        links.filter("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(),
        "links")
    while True:
        both = edges.select("high", "low").union(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = both.groupBy("high").agg(F.min("low").alias("near"))
        # Large star: larger neighbours of an id go below the least of its neighbours and itself.
        large = (
            edges.select(F.col("low").alias("mid"), F.col("high").alias("leaf"))
            .join(least.select(F.col("high").alias("mid"), "near"), "mid")
            .select(F.col("leaf").alias("high"), F.least("near", "mid").alias("low")).distinct())
        large = cut_lineage(large, "links")
        # Small star: an id and its smaller neighbours go below the least of these.
        root = large.groupBy("high").agg(F.min("low").alias("root"))
        small = large.join(root, "high")
        moved = small.filter("low <> root").select(F.col("low").alias("high"), F.col("root").alias("low"))
        after = cut_lineage(root.select("high", F.col("root").alias("low")).union(moved).distinct(), "links")
        # Done when every id hangs once, below an id that hangs nowhere.
        twice = after.groupBy("high").count().filter("count > 1").limit(1).count()
        deep = 0 if twice else after.join(
            after.select(F.col("low").alias("high")).distinct(), "high", "left_semi").limit(1).count()
        edges = after
        if not twice and not deep:
            return edges.select(F.col("high").alias("id"), F.col("low").alias("component")).union(
                edges.select(F.col("low").alias("id"), F.col("low").alias("component")).distinct())
