"""Connected components and size-checked broadcasts for the join operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: a side is broadcast only if its counted rows stay below this many bytes
BROADCAST_BYTES = 48 << 20


def hinted(df: DataFrame, row_bytes: int = 16) -> DataFrame:
    """``df`` (a stored table of fixed-width rows) with a broadcast hint if its
    counted size allows it; otherwise the join stays a shuffle join."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of ``links``: label is the smallest node
    that it is connected with.

    Alternating large-star and small-star steps over the links, each a grouped
    minimum and an equi-join; the links are stored after every round, and the
    rounds end when their smallest labels no longer change.
    """
    links = stored(links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).distinct(), "links")
    last = None
    while True:
        # large star: every larger neighbour of v is tied to v's smallest neighbour
        both = links.union(links.select("u", "v"))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v > u").distinct()
        # small star: every smaller neighbour and v itself are tied to the smallest one
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (large.join(low, "v").where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
                 .union(low.select("v", F.col("m").alias("u"))).distinct())
        links = stored(small, "links")
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")), F.countDistinct("u"), F.countDistinct("v")).first()
        if mark == last or mark[0] == mark[3] and links.join(links.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            return links.select(F.col("v").alias("node"), F.col("u").alias("label")).union(links.select("u", "u").distinct())
        last = mark
