"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return (both.join(least, "a").filter("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = (down.join(least, "a").filter("b <> m")
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()


def roots(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node that isn't its component's least node.

    ``links`` has columns a and b.  A node's neighbours are only reduced to their minimum and
    joined, never gathered, so a node with a third of all links is a skewed join side that
    adaptive execution splits.  Rounds grow with the logarithm of a component's size; each
    is written to the shared folder.
    """
    links = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    state = None
    while True:
        links = stored(_small(_large(links)), "stars")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
