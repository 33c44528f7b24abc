"""Display views: number texts and data-bar lengths. The reports themselves stay numeric."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.columns import ACCOUNT
from tallyshelf.functions.numbers import money_text, thousands_text
from tallyshelf.scratch import Scratch

# Fixed value: a data bar is empty at this number and full at the column's maximum.
BAR_START = 1

SALES_BARS = ("units_sold", "revenue", "remaining_units")
ON_HAND_BARS = ("on_hand", "received")


def _bar(value: Column, top: Column) -> Column:
    share = (value - BAR_START) / (top - BAR_START)
    return F.when(value.isNotNull() & (top > BAR_START), F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))


def with_bars(
    report: DataFrame, columns: Sequence[str] = SALES_BARS, by: Sequence[str] = (ACCOUNT,),
    scratch: Scratch | None = None,
) -> DataFrame:
    """Adds `<column>_bar` between 0 and 1 on product rows, against the largest product of the same report.

    The report is written, so that it is computed once for the maxima and the result. The maxima are an aggregate,
    written too, so that their size is known before they are joined back: a large report is neither gathered in a window nor
    shuffled.
    """
    scratch = scratch or Scratch(report.sparkSession)
    report = scratch.table(report, "report")
    is_product = ~F.col("is_total") if "is_total" in report.columns else F.lit(True)
    tops = report.filter(is_product).groupBy(*by).agg(*[F.max(c).alias(f"{c}_top") for c in columns])
    tops = scratch.table(tops, "tops")
    joined = report.join(tops, list(by), "left")
    bars = {f"{c}_bar": F.when(is_product, _bar(F.col(c), F.col(f"{c}_top"))) for c in columns}
    return joined.withColumns(bars).drop(*[f"{c}_top" for c in columns])


def sales_display(summary: DataFrame, by: Sequence[str] = (ACCOUNT,)) -> DataFrame:
    """The summary as text: thousands separators for units and stock, money for revenue."""
    return summary.select(
        *by, "report_rank", "sku", "product_name",
        thousands_text(F.col("units_sold")).alias("units_sold"),
        money_text(F.col("revenue")).alias("revenue"),
        thousands_text(F.col("remaining_units")).alias("remaining_units"),
    )
