"""Connected components of a graph of links, as a Spark job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """The smallest node each node can reach: node, component; nodes without a link are absent.

    ``edges`` has longs a and b. Alternating large-star and small-star steps hang every node's
    larger (then smaller) neighbours onto its smallest one until all components are stars: about
    log(nodes) rounds, each a grouping with partial sums and an equi-join, whose hot keys Spark
    can split. The state of a round is a written table of at most as many rows as there are links.
    """
    def distinct(df: DataFrame) -> DataFrame:
        return df.where("a <> b").distinct()

    stars = written(distinct(edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))), "stars")
    seen = None
    while True:
        around = _both_ways(stars)
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = around.join(least, "a").where("b > a").select(F.col("b").alias("a"),
                                                              F.col("low").alias("b"))
        large = written(distinct(large), "stars")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        small = down.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        stars = written(distinct(small.union(low.select("a", F.col("low").alias("b")))),
                            "stars")
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    centres = stars.select(F.col("b").alias("node")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        centres.select("node", F.col("node").alias("component")))
