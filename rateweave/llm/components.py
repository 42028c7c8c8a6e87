"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link: the smallest node it reaches.

    links: columns a, b.  Alternating rounds hang larger neighbours and then
    smaller neighbours of each node on its smallest one (Kiveris et al.,
    2014) until nothing changes; the rounds grow with the logarithm of the
    nodes.  Each round is written to the shared folder.  No node's links are
    ever gathered: a round is a grouped minimum and an equality join.
    """
    def least(pairs, keep_larger):
        low = written(pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")).select(
            F.col("a").alias("of"), "low"), "least")
        near = pairs.join(low, F.col("a") == F.col("of"))
        if keep_larger:
            return near.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        return near.select("b", F.col("low").alias("l")).unionByName(
            low.select(F.col("of").alias("b"), F.col("low").alias("l"))
        ).filter("b != l").select(F.col("b").alias("a"), F.col("l").alias("b"))

    def ordered(pairs):
        return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()

    now = written(ordered(links), "links")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = written(least(both, True).distinct(), "links")
        now = written(least(ordered(large), False).distinct(), "links")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
