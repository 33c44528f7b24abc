"""A status for every account that was asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshelf.columns import ACCOUNT

# States of a report.
OK = "OK"
NO_ORDERS = "NO_ORDERS"
ZERO_REVENUE = "ZERO_REVENUE"
NO_POSITIVE_SALES = "NO_POSITIVE_SALES"


def cover_accounts(requested: DataFrame, index: DataFrame, by: Sequence[str] = (ACCOUNT,)) -> DataFrame:
    """The report index with a row for each requested account or window, ordered or not."""
    return requested.select(*by).distinct().join(index, list(by), "left").withColumn(
        "status", F.coalesce("status", F.lit(NO_ORDERS))
    )
