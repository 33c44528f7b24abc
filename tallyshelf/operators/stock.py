"""Joins of SKU sums and stock."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.columns import ACCOUNT
from tallyshelf.operators.clean import zero
from tallyshelf.operators.copies import count_copies
from tallyshelf.operators.hot_joins import spread_join
from tallyshelf.scratch import Scratch

INVENTORY_POLICIES = ("as_is", "sum_per_sku")


def require_policy(policy: str) -> None:
    if policy not in INVENTORY_POLICIES:
        raise ValueError(f"inventory policy must be one of {INVENTORY_POLICIES}")


def stock_keys(by: Sequence[str], inventory: DataFrame) -> list[str]:
    """Report keys the stock has too: a snapshot knows its account but no report window."""
    return [k for k in by if k in inventory.columns]


def stock_per_sku(inventory: DataFrame, by: Sequence[str], policy: str = "as_is") -> DataFrame:
    """Stock rows to join to sales, with the number of equal rows each one stands for.

    "as_is" keeps repeated SKUs apart, so they repeat the sales row; "sum_per_sku" adds their stock up first.
    """
    require_policy(policy)
    keys = stock_keys(by, inventory)
    rows = inventory.filter(F.col("sku").isNotNull()).select(
        *keys, "sku", F.col("afn_fulfillable_quantity").alias("remaining_units")
    )
    if policy == "as_is":
        return count_copies(rows)
    return rows.groupBy(*keys, "sku").agg(F.sum("remaining_units").alias("remaining_units")).withColumn(
        "copies", F.lit(1).cast("bigint")
    )


def with_stock(sales: DataFrame, stock: DataFrame, by: Sequence[str], scratch: Scratch | None = None) -> DataFrame:
    """Every sales row with its stock; no stock row, or unreadable stock, is 0. With `scratch`, SKUs of very many rows are split, and `sales` is read twice."""
    keys = [*stock_keys(by, stock), "sku"]
    joined = sales.join(stock, keys, "left") if scratch is None else spread_join(sales, scratch.table(stock, "stock"), keys, scratch)
    return joined.withColumns({
        "remaining_units": F.coalesce("remaining_units", zero()),
        "copies": F.coalesce("copies", F.lit(1).cast("bigint")),
    })


def with_sold(inventory: DataFrame, sold: DataFrame, by: Sequence[str], scratch: Scratch | None = None) -> DataFrame:
    """Every stock row with the units sold of its SKU, 0 when none; never multiplies rows. With `scratch`, SKUs of very many rows are split.

    Rows without a SKU match nothing and go around the join, where they would all meet in one task.
    """
    inventory = inventory if scratch is None else scratch.table(inventory, "inventory")
    listed, keys = inventory.filter(F.col("sku").isNotNull()), [*by, "sku"]
    joined = listed.join(sold, keys, "left") if scratch is None else spread_join(listed, sold, keys, scratch, unique=True)
    named = joined.withColumn("sold", F.coalesce("sold", zero().cast(sold.schema["sold"].dataType)))
    unnamed = inventory.filter(F.col("sku").isNull()).withColumn("sold", zero().cast(sold.schema["sold"].dataType))
    return named.unionByName(unnamed)


# Optional part of a landed stock file's folder: when the snapshot was taken.
SNAPSHOT = "snapshot_ts"


def latest_snapshot(stock: DataFrame, as_of: Column | str) -> DataFrame:
    """Each account's stock rows of its last snapshot not after `as_of`; all rows if snapshots aren't told apart.

    Rows without a snapshot time are older than all others. One row per account leaves each map task.
    """
    if SNAPSHOT not in stock.columns:
        return stock
    at = F.try_to_timestamp(F.col(SNAPSHOT).cast("string"))
    due = stock.withColumn("taken", at).filter(at.isNull() | (at <= F.lit(as_of).cast("timestamp")))
    last = due.groupBy(ACCOUNT).agg(F.max(F.struct("taken", SNAPSHOT)).alias("last"))
    last = last.select(F.col(ACCOUNT).alias("its_account"), F.col(f"last.{SNAPSHOT}").alias("its_snapshot"))
    same = F.col(ACCOUNT).eqNullSafe(F.col("its_account")) & F.col(SNAPSHOT).eqNullSafe(F.col("its_snapshot"))
    return due.join(last, same, "left_semi").drop("taken", SNAPSHOT)
