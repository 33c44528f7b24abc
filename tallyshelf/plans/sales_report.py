"""The sales report of every account, or account and window, in one run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.columns import ACCOUNT, with_keys
from tallyshelf.errors import ZeroSalesError
from tallyshelf.functions.numbers import AMOUNT_TYPE
from tallyshelf.functions.text import sales_title
from tallyshelf.operators.clean import clean_orders, clean_stock, zero
from tallyshelf.operators.coverage import NO_ORDERS, NO_POSITIVE_SALES, OK, ZERO_REVENUE, cover_accounts
from tallyshelf.operators.ranking import block_starts, rank_rows, sort_into_blocks
from tallyshelf.operators.sku_sales import SUM_TYPE, sku_rollup, sold_products
from tallyshelf.operators.stock import stock_per_sku, with_stock
from tallyshelf.scratch import Scratch

# The texts of the total row.
TOTAL_SKU = "Grand Total"
TOTAL_PRODUCT = ""


def report_order() -> list[Column]:
    return [
        F.col("whole units_sold").desc(), F.col("rest units_sold").desc(), F.col("product_name"), F.col("sku"),
        F.col("whole remaining_units"), F.col("rest remaining_units"),
    ]


def gates(rollup: DataFrame, by: Sequence[str]) -> DataFrame:
    """Date range and status per report, over all order lines, paid or not."""
    paid_products = (F.col("paid_lines") > 0) & F.col("sku").isNotNull() & F.col("product_name").isNotNull()
    return rollup.groupBy(*by).agg(
        F.min("start_date").alias("start_date"),
        F.max("end_date").alias("end_date"),
        F.datediff(F.max("end_date"), F.min("start_date")).alias("days"),
        F.when(F.sum("price_sum") == 0, F.lit(ZERO_REVENUE))
        .when(F.count(F.when(paid_products, 1)) == 0, F.lit(NO_POSITIVE_SALES))
        .otherwise(F.lit(OK))
        .alias("status"),
    )


def line_sums(lines: DataFrame, by: Sequence[str]) -> DataFrame:
    """What `gates` needs of a roll-up, each line on its own: so no SKU or product is moved where the sums are not wanted."""
    named = F.col("sku").isNotNull() & F.col("product_name").isNotNull()
    paid = F.when((F.col("item_price") > 0) & named, 1).otherwise(0)
    return lines.select(
        *by, F.when(named, F.lit("")).alias("sku"), F.lit("").alias("product_name"), paid.alias("paid_lines"),
        F.coalesce("item_price", zero()).cast(SUM_TYPE).alias("price_sum"),
        F.col("purchase_date_fmt").alias("start_date"), F.col("purchase_date_fmt").alias("end_date"),
    )


def _ledger(status: DataFrame, ordered: DataFrame, by: Sequence[str]) -> DataFrame:
    """Status and sorted blocks of every report: all that the summary needs besides the product rows."""
    sums = (F.sum("units_sold").alias("block_units"), F.sum("revenue").alias("block_revenue"))
    return status.join(block_starts(ordered, by, *sums), list(by), "left")


def _block_totals(ledger: DataFrame, by: Sequence[str]) -> DataFrame:
    return ledger.groupBy(*by).agg(
        F.sum("block_units").alias("units_sold"), F.sum("block_revenue").alias("revenue")
    )


def _product_totals(products: DataFrame, by: Sequence[str]) -> DataFrame:
    def times(c: str) -> Column:
        # Types whose product keeps every decimal.
        return F.col(c).cast(AMOUNT_TYPE) * F.col("copies").cast("decimal(10,0)")

    return products.groupBy(*by).agg(F.sum(times("units_sold")).alias("units_sold"), F.sum(times("revenue")).alias("revenue"))


def _summary_rows(ranked: DataFrame, totals: DataFrame, by: Sequence[str]) -> DataFrame:
    products = ranked.select(
        *by, "sku", "product_name",
        F.col("units_sold").cast("double").alias("units_sold"),
        F.col("revenue").cast("double").alias("revenue"),
        F.col("remaining_units").cast("double").alias("remaining_units"),
        F.lit(False).alias("is_total"),
        "report_rank",
    )
    total_rows = totals.select(
        *by, F.lit(TOTAL_SKU).alias("sku"), F.lit(TOTAL_PRODUCT).alias("product_name"),
        F.col("units_sold").cast("double").alias("units_sold"),
        F.col("revenue").cast("double").alias("revenue"),
        F.lit(None).cast("double").alias("remaining_units"),
        F.lit(True).alias("is_total"),
        F.lit(1).cast("bigint").alias("report_rank"),
    )
    return products.unionByName(total_rows)


def _index_rows(status: DataFrame, totals: DataFrame, by: Sequence[str]) -> DataFrame:
    reports = status.join(totals, list(by), "left")
    fine = F.col("status") == OK
    account = F.col(ACCOUNT) if ACCOUNT in by else F.lit(None).cast("string")
    title = sales_title(account, F.col("start_date"), F.col("end_date"), F.col("days"),
                        F.col("units_sold"), F.col("revenue"))
    return reports.select(
        *by, "start_date", "end_date", "days",
        F.when(fine, F.col("units_sold").cast("double")).alias("units_sold"),
        F.when(fine, F.col("revenue").cast("double")).alias("revenue"),
        F.when(fine, title).alias("report_name"),
        "status",
    )


def reported_rows(rows: DataFrame, status: DataFrame, by: Sequence[str], scratch: Scratch) -> DataFrame:
    """`rows` of reports that are OK. The others are written, so their size decides how they are joined."""
    dropped = scratch.table(status.filter(F.col("status") != OK).select(*by), "dropped")
    return rows.join(dropped, list(by), "left_anti")


def raw_rows(lines: DataFrame) -> DataFrame:
    """Source columns with the numbers cleaned, and the purchase day."""
    return lines.withColumns({
        "item_price": F.col("item_price").cast("double"), "quantity": F.col("quantity").cast("double"),
    })


@dataclass
class SalesReport:
    """The parts of the report, each planned when first asked for.

    Order lines are read once for everything but the raw data. What is written in between has one row per SKU and
    product (`rollup`, `ordered`) or per report and sorted block (`ledger`).
    """

    lines: DataFrame
    stock: DataFrame
    by: tuple[str, ...]
    scratch: Scratch
    requested: DataFrame | None = None
    rolled: DataFrame | None = None

    @cached_property
    def rollup(self) -> DataFrame:
        """From the lines, or as it was made from kept sums."""
        if self.rolled is not None:
            return self.scratch.table(self.rolled, "rollup")
        return self.scratch.table(sku_rollup(self.lines, self.by), "rollup")

    @cached_property
    def status(self) -> DataFrame:
        """Date range and status of each report."""
        return gates(self.rollup, self.by)

    @cached_property
    def products(self) -> DataFrame:
        return with_stock(sold_products(self.rollup, self.by), self.stock, self.by, self.scratch)

    @cached_property
    def ordered(self) -> DataFrame:
        # Written first: the sort runs its input twice, once for the sample, and this one holds the stock join.
        products = self.scratch.table(self.products, "products")
        return sort_into_blocks(products, self.by, report_order(), self.scratch, ("units_sold", "remaining_units"))

    @cached_property
    def ledger(self) -> DataFrame:
        return self.scratch.table(_ledger(self.status, self.ordered, self.by), "ledger")

    @property
    def totals(self) -> DataFrame:
        """Units and revenue over the joined rows: from the sorted blocks once there are any, so that an index or
        totals alone need no sort."""
        if "ledger" in self.__dict__:
            return _block_totals(self.ledger.filter(F.col("status") == OK), self.by)
        made = self.status.filter(F.col("status") == OK).select(*self.by)
        return _product_totals(self.products, self.by).join(made, list(self.by))

    @cached_property
    def summary(self) -> DataFrame:
        """Total row first, then products by units sold, for the reports that are OK."""
        made = self.ledger.filter(F.col("status") == OK)
        return _summary_rows(rank_rows(self.ordered, made, self.by, first=2), self.totals, self.by)

    @cached_property
    def index(self) -> DataFrame:
        """One row per report with its title and status, and one for each requested report without orders."""
        index = _index_rows(self.status, self.totals, self.by)
        return index if self.requested is None else cover_accounts(self.requested, index, self.by)

    @cached_property
    def raw_data(self) -> DataFrame:
        """The cleaned order lines of the reports that are OK."""
        made = self.rolled is not None or "rollup" in self.__dict__
        status = self.status if made else gates(line_sums(self.lines, self.by), self.by)
        return raw_rows(reported_rows(self.lines, status, self.by, self.scratch))


def sales_report(
    orders: DataFrame,
    inventory: DataFrame,
    by: Sequence[str] = (ACCOUNT,),
    inventory_policy: str = "as_is",
    scratch: Scratch | None = None,
    requested: DataFrame | None = None,
) -> SalesReport:
    """Sales per SKU with stock, totals, positions and titles, for each combination of the `by` columns.

    `requested` lists reports that shall have an index row even without orders.
    """
    lines = clean_orders(with_keys(orders, by))
    stock = clean_stock(inventory)
    if ACCOUNT in stock.columns:
        stock = with_keys(stock, [ACCOUNT])
    stock = stock_per_sku(stock, by, inventory_policy)
    return SalesReport(lines, stock, tuple(by), scratch or Scratch(orders.sparkSession), requested)


def account_sales_report(
    orders: DataFrame, inventory: DataFrame, account: str | None = None, inventory_policy: str = "as_is"
) -> SalesReport:
    """The report of one account; raises when there is nothing to report.

    Tables without an account column, or no account named, are taken to be one account's own.
    """
    def own(df: DataFrame) -> DataFrame:
        if ACCOUNT in df.columns and account is not None:
            return df.filter(F.col(ACCOUNT) == account)
        return df.withColumn(ACCOUNT, F.lit(account or ""))

    report = sales_report(own(orders), own(inventory), inventory_policy=inventory_policy)
    require_sales(report.status)
    return report


def require_sales(status: DataFrame) -> None:
    first = status.select("status").head(1)
    found = first[0]["status"] if first else NO_ORDERS
    if found != OK:
        raise ZeroSalesError(f"no sales for this account and range: {found}")
