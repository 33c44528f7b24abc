"""Sums of cleaned order lines. Every aggregate combines inside the map tasks first, so hot SKUs stay small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyshelf.operators.clean import zero


def _sum(c: Column | str) -> Column:
    return F.coalesce(F.sum(c), zero())


def paid_orders(orders: DataFrame) -> DataFrame:
    """Order lines with a price above zero, before cleaning: on a numeric column the scan itself skips the others.

    Prices held as text are left to the cleaning step.
    """
    price = "item_price" if "item_price" in orders.columns else "item-price"
    if not isinstance(orders.schema[price].dataType, T.NumericType):
        return orders
    return orders.filter(F.col(f"`{price}`") > 0)


def sales_by_sku(lines: DataFrame, by: Sequence[str]) -> DataFrame:
    """Units and revenue per SKU and product over paid lines."""
    keyed = F.col("sku").isNotNull() & F.col("product_name").isNotNull()
    return (
        lines.filter((F.col("item_price") > 0) & keyed)
        .groupBy(*by, "sku", "product_name")
        .agg(_sum("quantity").alias("units_sold"), _sum("item_price").alias("revenue"))
    )


# What sums of amounts are, however often they are added up.
SUM_TYPE = T.DecimalType(37, 8)


def sku_rollup(lines: DataFrame, by: Sequence[str], all_units: bool = False) -> DataFrame:
    """Everything both the summary and the report index need, from one pass over the order lines; the on-hand report needs `all_units`."""
    paid = F.col("item_price") > 0
    more = [_sum("quantity").alias("all_units")] if all_units else []
    return lines.groupBy(*by, "sku", "product_name").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count(F.when(paid, 1)).alias("paid_lines"),
        _sum("item_price").alias("price_sum"),
        _sum(F.when(paid, F.col("quantity"))).alias("units_sold"),
        _sum(F.when(paid, F.col("item_price"))).alias("revenue"),
        F.min("purchase_date_fmt").alias("start_date"),
        F.max("purchase_date_fmt").alias("end_date"),
        *more,
    )


def sold_products(rollup: DataFrame, by: Sequence[str]) -> DataFrame:
    """The summary's product rows out of the roll-up."""
    keyed = F.col("sku").isNotNull() & F.col("product_name").isNotNull()
    return rollup.filter((F.col("paid_lines") > 0) & keyed).select(
        *by, "sku", "product_name", "units_sold", "revenue"
    )


def sold_units(orders: DataFrame, by: Sequence[str]) -> DataFrame:
    """Units per SKU over all lines, paid or not."""
    return orders.filter(F.col("sku").isNotNull()).groupBy(*by, "sku").agg(_sum("quantity").alias("sold"))
