"""Connected components of a table of links, by alternating large and small stars.

Each round is a few aggregations and joins over the links, which are written between rounds; the number of rounds grows
with the logarithm of the largest component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshelf.llm.common import moved
from tallyshelf.scratch import Scratch


def _large_star(links: DataFrame) -> DataFrame:
    """Connects every node's larger neighbours to the smallest node around it."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    rows = both.join(moved(least), "u").where(F.col("v") > F.col("u"))
    return rows.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Connects every node and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    rows = down.join(moved(least), "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return rows.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()


def _print_of(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """One row (node, root) for every node in `links` (a, b); the root is the smallest node of the component."""
    links = scratch.table(links.select("a", "b").where("a <> b").distinct(), "links")
    before = None
    while (now := _print_of(links)) != before:
        before = now
        links = scratch.table(_small_star(_large_star(links)), "links")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
