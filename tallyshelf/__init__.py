"""Seller sales reports on Spark, for all accounts and date windows in one run."""

from tallyshelf.errors import NoReadyReportError, ZeroSalesError
from tallyshelf.plans.on_hand import on_hand_index, on_hand_report
from tallyshelf.plans.presentation import sales_display, with_bars
from tallyshelf.plans.sales_report import SalesReport, account_sales_report, sales_report
from tallyshelf.scratch import Scratch
from tallyshelf.session import configure, session

__all__ = [
    "NoReadyReportError", "SalesReport", "Scratch", "ZeroSalesError", "account_sales_report", "configure",
    "on_hand_index", "on_hand_report", "sales_display", "sales_report", "session", "with_bars",
]
