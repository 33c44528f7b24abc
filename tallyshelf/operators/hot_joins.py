"""Joins where one key may hold very many rows on either side, split without waiting for the engine to see the skew.

The rows of a hot key are dealt over parts by a hash of all their columns, and the other side's rows of that key are repeated for each part.
If both sides are hot there, the parts form a grid, and each pair of rows meets in one cell. Keys that are not hot are one cell and
are moved as in any join.

Equal rows go to one part: count them first (`count_copies`). Null keys match nothing and count as not hot. Empty sides are joined as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.scratch import Scratch

# Documented parameters: a key with more rows than these, and than a shuffle partition's share by FINE, is split. No side has
# more than HOT_KEYS of them, which are broadcast.
HOT_ROWS, FINE, HOT_KEYS = 100_000, 4, 10_000
# Documented parameter: counters that keys share. Only keys whose counter is high are counted on their own.
BUCKETS = 1 << 16
# Names of the parts of a key on either side, and of a row's cell.
LEFT_PARTS, RIGHT_PARTS, LEFT_CELL, RIGHT_CELL, MATCHED = "left_parts", "right_parts", "left_cell", "right_cell", "matched"


def part_size(rows: int, partitions: int) -> int:
    """Rows of one key that stay together: fewer than `rows` / HOT_KEYS never make a key hot."""
    return max(HOT_ROWS, -(-rows // (FINE * partitions)), -(-rows // HOT_KEYS))


def hot_keys(df: DataFrame, keys: Sequence[str], parts: str) -> DataFrame | None:
    """Keys with too many rows, and the parts to split each into: none if the table has too few rows for that.

    Keys are counted by buckets of their hash first, of which BUCKETS rows leave each map task; a hot key's bucket holds no less than the
    key, so keys in the other buckets are not moved. At most HOT_KEYS rows, as each stands for more than a HOT_KEYS-th of the table.
    """
    rows = df.count()
    most = part_size(rows, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if rows <= most:
        return None
    there = reduce(Column.__and__, [F.col(f"`{k}`").isNotNull() for k in keys])
    bucket, listed = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(BUCKETS)), df.filter(there)
    full = listed.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > most)
    # Fewer than HOT_KEYS numbers.
    buckets = [row["bucket"] for row in full.collect()]
    if not buckets:
        return df.select(*keys).limit(0).withColumn(parts, F.lit(0))
    counted = listed.filter(bucket.isin(buckets)).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > most)
    return counted.select(*keys, F.expr(f"cast((rows + {most - 1}) div {most} as int)").alias(parts))


def _cells(df: DataFrame, hot: DataFrame, keys: Sequence[str], own: tuple[str, str], others: tuple[str, str]) -> DataFrame:
    """Rows with their own part, once for each part of the other side."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    n, m = (F.coalesce(F.col(parts), F.lit(1)) for parts in (own[0], others[0]))
    part = F.pmod(F.xxhash64(*columns), n).cast("int").alias(own[1])
    repeat = F.explode(F.sequence(F.lit(0), m - 1)).alias(others[1])
    return df.join(F.broadcast(hot), list(keys), "left").select(*columns, part, repeat, F.col(others[0]).isNotNull().alias("others_hot"))


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], scratch: Scratch, how: str = "left", unique: bool = False) -> DataFrame:
    """`left` joined with `right` on equal keys, "left" or "inner", with the rows and columns of `left.join(right, keys, how)`.

    Both are read once more to count their keys, so they should be written tables or cheap to read. `unique` says that `right` has
    a row for each key at most, and needs no count.
    """
    if how not in ("left", "inner"):
        raise ValueError("a spread join is 'left' or 'inner'")
    keys = list(keys)
    found = [hot_keys(left, keys, LEFT_PARTS), None if unique else hot_keys(right, keys, RIGHT_PARTS)]
    if found == [None, None]:
        return left.join(right, keys, how)
    empty = left.select(*keys).limit(0)
    sides = [df if df is not None else empty.withColumn(parts, F.lit(0)) for df, parts in zip(found, (LEFT_PARTS, RIGHT_PARTS))]
    hot = scratch.table(sides[0].join(sides[1], keys, "full"), "hot")
    if hot.isEmpty():
        return left.join(right, keys, how)
    mine, theirs = (LEFT_PARTS, LEFT_CELL), (RIGHT_PARTS, RIGHT_CELL)
    dealt = _cells(left, hot, keys, mine, theirs)
    facing = _cells(right, hot, keys, theirs, mine).drop("others_hot").withColumn(MATCHED, F.lit(True))
    joined = dealt.join(facing, [*keys, LEFT_CELL, RIGHT_CELL], how)
    # A key that is hot on the right has a match, so a cell without one says nothing.
    kept = joined.filter(F.col(MATCHED).isNotNull() | ~F.col("others_hot")) if how == "left" else joined
    return kept.drop(LEFT_CELL, RIGHT_CELL, MATCHED, "others_hot")
