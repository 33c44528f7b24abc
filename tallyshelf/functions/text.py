"""Report titles. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyshelf.functions.dates import title_day
from tallyshelf.functions.numbers import integral_text


def account_prefix(account: Column) -> Column:
    named = account.isNotNull() & (account != "")
    return F.when(named, F.concat(F.upper(account), F.lit(" "))).otherwise(F.lit(""))


def sales_title(account: Column, start: Column, end: Column, days: Column, units: Column, revenue: Column) -> Column:
    """One date when the range is at most a day long, otherwise first and last date."""
    dates = F.when(days <= 1, title_day(start)).otherwise(
        F.concat(title_day(start), F.lit(" through "), title_day(end))
    )
    return F.concat(
        account_prefix(account), F.lit("Sales "), dates, F.lit(" ("), integral_text(units), F.lit(" units, $"),
        F.format_number(revenue, 2), F.lit(")"),
    )


def on_hand_title(account: Column, as_of: Column) -> Column:
    return F.concat(account_prefix(account), F.lit("On Hand "), title_day(as_of))
