"""Equal rows carried as one row and a count through a shuffle, and written out again after it.

A third of a table may be copies of one row. Counting them first keeps that group out of any single join or sort
task; `expand_copies` restores every copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Copies one sorted row may stand for. Larger groups are spread over several rows before the sort, so a sort task
# writes at most this many times the rows it sorted.
CHUNK = 16

# Numbers listed at a time while a group is spread: bounds the array that is exploded.
SPAN = 4096


def count_copies(df: DataFrame) -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))


def _long(n: int) -> Column:
    return F.lit(n).cast("bigint")


def chunk_copies(df: DataFrame) -> DataFrame:
    """One row per CHUNK copies, numbered by `chunk` from 0; `copies` becomes the count inside the chunk."""
    last = F.expr(f"(copies - 1) div {CHUNK}")
    spans = F.sequence(_long(0), F.expr(f"(copies - 1) div {CHUNK * SPAN}"))
    first = F.col("span") * SPAN
    chunks = F.sequence(first, F.least(first + (SPAN - 1), last))
    left = F.col("copies") - F.col("chunk") * CHUNK
    spread = df.withColumn("span", F.explode(spans)).withColumn("chunk", F.explode(chunks)).drop("span")
    return spread.withColumn("copies", F.least(left, _long(CHUNK)))


def expand_copies(df: DataFrame) -> DataFrame:
    """Every copy as its own row, in place: the order of the input is kept."""
    copy = F.explode(F.sequence(_long(1), F.col("copies")))
    return df.withColumn("copy", copy).drop("copy", "copies", "chunk")
