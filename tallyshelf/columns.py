"""Column names, required sets and fixed values of the seller report files."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCOUNT = "account_name"

# Headers of the seller files, and the names used inside the package.
SOURCE_TO_INTERNAL = {
    "product-name": "product_name",
    "purchase-date": "purchase_date",
    "purchase-date-fmt": "purchase_date_fmt",
    "item-price": "item_price",
    "afn-fulfillable-quantity": "afn_fulfillable_quantity",
}

# Headers of the finished reports.
SUMMARY_HEADERS = {
    "product_name": "product-name",
    "units_sold": "units sold",
    "revenue": "revenue",
    "remaining_units": "remaining units",
}
RAW_HEADERS = {internal: source for source, internal in SOURCE_TO_INTERNAL.items()}
ON_HAND_HEADERS = {"product_name": "product-name", "on_hand": "on-hand"}

# Columns each report needs, in source spelling.
SALES_ORDER_COLUMNS = ("sku", "product-name", "purchase-date", "item-price", "quantity")
SALES_STOCK_COLUMNS = ("sku", "afn-fulfillable-quantity")
ON_HAND_ORDER_COLUMNS = ("sku", "quantity")
ON_HAND_STOCK_COLUMNS = ("sku", "asin", "product-name", "afn-fulfillable-quantity")

# Report types of the upstream reporting service.
ORDERS_REPORT = "GET_FLAT_FILE_ALL_ORDERS_DATA_BY_ORDER_DATE_GENERAL"
INVENTORY_REPORT = "GET_FBA_MYI_UNSUPPRESSED_INVENTORY_DATA"

# Field texts that a flat-file reader takes as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def to_internal(df: DataFrame) -> DataFrame:
    """Source spelling to package names; unknown columns keep theirs."""
    return df.withColumnsRenamed({s: i for s, i in SOURCE_TO_INTERNAL.items() if s in df.columns})


def to_headers(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({i: h for i, h in headers.items() if i in df.columns})


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Required columns that `df` has in neither spelling, in the order required."""
    present = set(df.columns)
    return [c for c in required if c not in present and SOURCE_TO_INTERNAL.get(c) not in present]


def with_keys(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Text keys are never null: no account is the empty account, which has no title prefix."""
    if ACCOUNT in by and ACCOUNT not in df.columns:
        return df.withColumn(ACCOUNT, F.lit(""))
    if ACCOUNT in by:
        return df.withColumn(ACCOUNT, F.coalesce(F.col(ACCOUNT).cast("string"), F.lit("")))
    return df
