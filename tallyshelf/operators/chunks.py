"""Many report chunks as one table without copies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyshelf.operators.clean import canonical_number
from tallyshelf.scratch import Scratch

# Columns whose texts are names, not numbers, even if all digits.
TEXT_COLUMNS = (
    "account_name", "sku", "asin", "product-name", "product_name", "purchase-date", "purchase_date", "order_id",
    "amazon-order-id", "merchant-order-id", "rejected_line", "snapshot_ts",
)


# Documented parameter: hashes that several rows share, up to this many, are broadcast; beyond it all rows are moved.
SHARED_HASHES = 1_000_000
# Names of a row's hash, and of the mark of rows that share theirs.
HASH, SHARED = "row hash", "shares hash"


def union_chunks(chunks: Sequence[DataFrame]) -> DataFrame:
    """Columns matched by name; a column some chunks lack is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), chunks)


def _spelled(df: DataFrame) -> list[str]:
    """Text columns that may hold numbers."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in TEXT_COLUMNS]


def distinct_table(df: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """`distinct_rows(df)` of text cells, written. Where few rows have copies, only a hash of each row is moved, and the rows that share theirs.

    `df` is read twice. Rows of equal hash are compared whole, so two rows that share one by chance both stay.
    """
    spelled = _spelled(df)
    hashed = F.xxhash64(*[canonical_number(df, n) if n in spelled else F.col(f"`{n}`") for n in df.columns])
    counted = df.groupBy(hashed.alias(HASH)).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1).select(HASH)
    shared = scratch.table(counted, "shared")
    found = shared.count()
    if not found:
        return scratch.table(df, name)
    if found > SHARED_HASHES:
        return scratch.table(distinct_rows(df), name)
    marks = F.broadcast(shared.withColumn(SHARED, F.lit(True)))
    marked = df.withColumn(HASH, hashed).join(marks, HASH, "left").withColumn(SHARED, F.col(SHARED).isNotNull())
    rows = scratch.table(marked.select(*[F.col(f"`{c}`") for c in df.columns], SHARED), name)
    copies = scratch.table(distinct_rows(rows.filter(F.col(SHARED)).drop(SHARED)), "copies")
    return rows.filter(~F.col(SHARED)).drop(SHARED).unionByName(copies)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Rows equal in every column, nulls included, collapse to one; copies merge before the shuffle.

    Two spellings of a number are equal. Cells stay as they arrived: of several spellings the first in text order.
    """
    spelled = _spelled(df)
    if not spelled:
        return df.dropDuplicates()
    keys = {f"key {i}": canonical_number(df, n) for i, n in enumerate(spelled)}
    others = [F.col(f"`{n}`") for n in df.columns if n not in spelled]
    found = df.select("*", *[k.alias(n) for n, k in keys.items()]).groupBy(*others, *[F.col(f"`{n}`") for n in keys]).agg(
        *[F.min(f"`{n}`").alias(n) for n in spelled])
    return found.select(*[F.col(f"`{n}`") for n in df.columns])


def merge_chunks(chunks: Sequence[DataFrame]) -> DataFrame:
    return distinct_rows(union_chunks(chunks))
