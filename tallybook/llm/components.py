"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import settled


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) of every node in ``links`` (u, v); root is its component's least node.

    Each round ties every node to the least of its neighbours (large star),
    then the smaller neighbours to it (small star).  The links left are at most
    one a node, the rounds grow with the logarithm of a component's size, and
    only counts reach the driver.  Least neighbours are aggregated ahead of the
    shuffle; the join that follows is one adaptive execution can split, so a
    node with very many neighbours is no bottleneck.  Loops and repeated links
    do no harm.
    """
    current = settled(_downward(links.select("u", "v")))
    before = None
    while (now := _fingerprint(current)) != before:
        before = now
        current = settled(_small_star(_large_star(current)))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _downward(links: DataFrame) -> DataFrame:
    """From the larger to the smaller node, each link once."""
    links = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return links.distinct()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return _downward(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return _downward(moved.unionByName(least.select("u", F.col("least").alias("v"))))


def _fingerprint(links: DataFrame) -> tuple:
    row = links.select(F.xxhash64("u", "v").cast("decimal(38,0)").alias("h")).agg(F.count("*"), F.sum("h")).first()
    return tuple(row)
