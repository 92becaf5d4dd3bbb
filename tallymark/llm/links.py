"""Connected components of a link table, as DataFrame work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.operators.staging import discard, stage


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _only_stars(links: DataFrame) -> bool:
    """Whether each node has one link to a smaller node, and none of those has one itself."""
    degrees = links.select("a", F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        links.select(F.col("b").alias("a"), F.lit(0), F.lit(1))
    )
    sums = degrees.groupBy("a").agg(F.sum("down").alias("down"), F.sum("up").alias("up"))
    return not sums.where("down > 1 or (down > 0 and up > 0)").head(1)


def components(links: DataFrame) -> DataFrame:
    """Label every linked node (a, b of the links) with the smallest node that it can reach.

    Nodes that are their own label, the smallest of each component, are not listed.

    Alternates the large-star and small-star steps of Kiveris et al. (2014) until only stars are left.
    Minima are added up before the shuffle, and each round is written to the shared folder.
    """
    now = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _only_stars(now):
        both = _both_ways(now)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.union(least.where("a <> m").select("a", F.col("m").alias("b"))).distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        before, now = now, stage(small.union(smallest.select("a", F.col("m").alias("b"))).distinct(), "links")
        discard(before)
    return now.groupBy("a").agg(F.min("b").alias("label")).select(F.col("a").alias("node"), "label")
