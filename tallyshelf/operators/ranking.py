"""Report positions without gathering a group in one task.

A window per account would sort that account in a single task, and one account may own a third of the rows. Here the
rows are range-sorted over all accounts at once and written, so a large account spans many sorted blocks. Each
block's size then gives the position its first row starts at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tallyshelf.operators.copies import chunk_copies, expand_copies
from tallyshelf.scratch import Scratch

# monotonically_increasing_id keeps the task number above this bit and the row number below it.
BLOCK_BITS = 33
# Whole numbers up to here are compared as such.
WHOLE = 9 * 10**15


def number_keys(c: str, kind: DataType) -> tuple[Column, Column]:
    """Two columns that order rows as decimal column `c` of type `kind` does: its whole part as a long, and the rest, null for none and before all others.

    Wide decimals are made into objects whenever two are compared; most pairs are told apart by the longs, and whole numbers have no rest.
    """
    n, whole = F.col(c), F.floor(F.col(c))
    small = F.abs(n) < F.lit(WHOLE)
    end = F.when(n > 0, F.lit(WHOLE)).when(n < 0, F.lit(-WHOLE - 1))
    return F.when(small, whole.cast("bigint")).otherwise(end), F.when(small, F.nullif((n - whole.try_cast(kind)).cast(kind), F.lit(0).cast(kind))).otherwise(n)


def number_of_keys(c: str, kind: DataType) -> Column:
    """The column that `number_keys` made "whole <c>" and "rest <c>" of."""
    whole, rest = F.col(f"whole {c}"), F.col(f"rest {c}").cast(kind)
    held = whole.cast(kind)
    return F.when(~whole.between(-WHOLE, WHOLE - 1), rest).when(rest.isNull(), held).otherwise((held + rest).cast(kind))


def sort_into_blocks(rows: DataFrame, by: Sequence[str], order: Sequence[Column], scratch: Scratch, numbers: Sequence[str] = ()) -> DataFrame:
    """`rows` in report order with `block` and `seat`, the place inside it. Rows may carry `copies`. For decimal columns in `numbers`, `order` may use
    "whole <name>" and "rest <name>", see `number_keys`.

    Written once: sort boundaries come from a sample, so the numbers must not be computed twice.
    """
    last = []
    if "copies" in rows.columns:
        rows = chunk_copies(rows)
        last = [F.col("chunk")]
    columns, kinds = rows.columns, {n: rows.schema[n].dataType for n in numbers}
    for n, kind in kinds.items():
        # The keys are moved in the number's place.
        rows = rows.withColumns({f"{part} {n}": key for part, key in zip(("whole", "rest"), number_keys(n, kind))}).drop(n)
    rows = rows.orderBy(*[F.col(k) for k in by], *order, *last)
    if numbers:
        rows = rows.withColumns({n: number_of_keys(n, kind) for n, kind in kinds.items()}).select(*columns)
    if last:
        rows = expand_copies(rows)
    place = F.col("place")
    rows = rows.withColumn("place", F.monotonically_increasing_id()).withColumns({
        "block": F.shiftright(place, BLOCK_BITS),
        "seat": place.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)),
    }).drop("place")
    return scratch.table(rows, "sorted")


def block_starts(rows: DataFrame, by: Sequence[str], *sums: Column) -> DataFrame:
    """One row per group and block with `shift`, what turns a seat into a 0-based position, and the `sums`.

    As many rows as groups plus blocks, whatever the number of rows; the window runs over those only.
    """
    blocks = rows.groupBy(*by, "block").agg(
        F.min("seat").alias("first_seat"), F.count(F.lit(1)).alias("block_rows"), *sums
    )
    before = Window.partitionBy(*by).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("block_rows").over(before), F.lit(0)) - F.col("first_seat")
    return blocks.withColumn("shift", shift).drop("first_seat", "block_rows")


def rank_rows(rows: DataFrame, starts: DataFrame, by: Sequence[str], first: int = 1) -> DataFrame:
    """Adds `report_rank`, counting from `first` in every group. Groups that `starts` lacks drop out.

    Pass `starts` as a written table: its size is then known, and decides whether it is broadcast.
    """
    ranked = rows.join(starts.select(*by, "block", "shift"), [*by, "block"])
    rank = (F.col("seat") + F.col("shift") + first).cast("bigint")
    return ranked.withColumn("report_rank", rank).drop("block", "seat", "shift")
