"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgrain.llm.common import cut


def _large_star(links: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of its neighbours and itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours, and itself, to the smallest of them. a > b in links."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.withColumnRenamed("least", "b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """links: a, b (different 64-bit nodes). Returns node and component, the smallest node it is linked
    to, of each node but those smallest ones. Only counts and a checksum reach the driver."""
    links = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        links = cut(_small_star(_large_star(links)))
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = state
