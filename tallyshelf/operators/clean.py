"""Validation and cleaning of order lines and stock rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyshelf import columns as C
from tallyshelf.functions.dates import purchase_day
from tallyshelf.functions.numbers import AMOUNT_TYPE, amount, amount_or_zero, blank_to_null, inexact, unreadable


def require_columns(df: DataFrame, required: Sequence[str], error: type[Exception] = ValueError) -> DataFrame:
    missing = C.missing_columns(df, required)
    if missing:
        raise error(f"missing columns: {', '.join(missing)}")
    return df


def _text(df: DataFrame, name: str, tokens: Sequence[str]) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        return blank_to_null(name, tokens)
    return F.col(name).cast("string")


def clean_orders(orders: DataFrame, null_tokens: Sequence[str] = C.NULL_TOKENS) -> DataFrame:
    """Order lines with numeric price and quantity and the purchase day; every source column is kept.

    Missing numbers become 0; text that is no number becomes NULL. SKUs stay text, so leading zeros survive.
    """
    df = C.to_internal(require_columns(orders, C.SALES_ORDER_COLUMNS))
    return df.withColumns({
        "sku": _text(df, "sku", null_tokens),
        "product_name": _text(df, "product_name", null_tokens),
        "item_price": amount_or_zero(df, "item_price", null_tokens),
        "quantity": amount_or_zero(df, "quantity", null_tokens),
        "purchase_date_fmt": purchase_day(F.col("purchase_date")),
    })


def clean_stock(inventory: DataFrame, null_tokens: Sequence[str] = C.NULL_TOKENS) -> DataFrame:
    df = C.to_internal(require_columns(inventory, C.SALES_STOCK_COLUMNS))
    return df.withColumns({
        "sku": _text(df, "sku", null_tokens),
        "afn_fulfillable_quantity": amount_or_zero(df, "afn_fulfillable_quantity", null_tokens),
    })


def quarantine(orders: DataFrame, null_tokens: Sequence[str] = C.NULL_TOKENS) -> DataFrame:
    """Order lines the reports cannot use fully, as they arrived, with the reasons."""
    df = C.to_internal(require_columns(orders, C.SALES_ORDER_COLUMNS))
    checks = {
        "sku_missing": _text(df, "sku", null_tokens).isNull(),
        "product_name_missing": _text(df, "product_name", null_tokens).isNull(),
        "purchase_date_unreadable": purchase_day(F.col("purchase_date")).isNull(),
        "item_price_unreadable": unreadable(df, "item_price", null_tokens),
        "quantity_unreadable": unreadable(df, "quantity", null_tokens),
        "item_price_rounded": inexact(df, "item_price"),
        "quantity_rounded": inexact(df, "quantity"),
    }
    reasons = F.concat_ws(",", *[F.when(bad, F.lit(name)) for name, bad in checks.items()])
    # A filter on an exploded column stays above it, so each check is made once a line, not once for the filter and once for the reasons.
    found = df.select("*", F.explode(F.array(reasons)).alias("reasons")).filter(F.col("reasons") != "")
    return found.withColumn("reasons", F.split("reasons", ","))


# Numbers whose canonical spelling is their own, filled up with zeros.
PLAIN_NUMBER, PLAIN_INTEGER = r"^[1-9][0-9]{0,17}\.[0-9]{1,8}\z", r"^[1-9][0-9]{0,17}\z"
ZEROS = ("0", "0.0", "0.00")


def canonical_number(df: DataFrame, name: str) -> Column:
    """Text column `name` with numbers in one spelling ('12.50' and '12.5' agree).

    Other text stays, and so do numbers too fine to hold and those with leading zeros, which are codes. Numbers as files mostly have them
    are filled up as text, which takes a fraction of the casts.
    """
    c = F.col(f"`{name}`")
    point = F.instr(c, ".")
    filled = F.rpad(c, point + 8, "0")
    return (
        F.when(c.isin(*ZEROS), zero().cast("string"))
        .when((point > 0) & c.rlike(PLAIN_NUMBER), filled)
        .when((point == 0) & c.rlike(PLAIN_INTEGER), F.concat(c, F.lit(".00000000")))
        .otherwise(_canonical(df, name))
    )


def _canonical(df: DataFrame, name: str) -> Column:
    """The same for any text."""
    c = F.col(f"`{name}`")
    code = F.trim(c).rlike("^[+-]?0[0-9]")
    exact = amount(df, name).isNotNull() & ~inexact(df, name) & ~code
    return F.when(exact, amount(df, name).cast("string")).otherwise(c)


def zero() -> Column:
    return F.lit(0).cast(AMOUNT_TYPE)
