"""Report requests: checking, presets, long ranges, and which order line belongs to which window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.columns import ACCOUNT, to_internal
from tallyshelf.functions.dates import (
    REQUEST_ZONE, eastern_midnight_utc, iso_utc, purchase_day, request_day, title_day, whole_days,
)
from tallyshelf.operators.intervals import IntervalJoin
from tallyshelf.scratch import Scratch

# The longest window of one report, the default window, and the preset ranges, in days.
MAX_DAYS = 31
DEFAULT_DAYS = 1
PRESET_DAYS = {"today": 0, "one_month_ago": 30, "two_months_ago": 60, "three_months_ago": 90}


def _as_ts(as_of: Column | str) -> Column:
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp")


def _bounds(requests: DataFrame, as_of: Column) -> DataFrame:
    """Window bounds as instants: given days start at Eastern midnight, missing ones count back from `as_of`."""
    start, end = F.col("start_date"), F.col("end_date")
    return requests.withColumns({
        "start_utc": F.when(start.isNull(), as_of - F.expr(f"INTERVAL {DEFAULT_DAYS} DAYS")).otherwise(
            eastern_midnight_utc(request_day(start))
        ),
        "end_utc": F.when(end.isNull(), as_of).otherwise(eastern_midnight_utc(request_day(end))),
    })


def _error(as_of: Column, max_days: int | None) -> Column:
    start, end = F.col("start_utc"), F.col("end_utc")
    account = F.col(ACCOUNT)
    error = (
        F.when(account.isNull() | (account == ""), F.lit("account_name is missing"))
        .when(start.isNull(), F.lit("start_date is not a date"))
        .when(end.isNull(), F.lit("end_date is not a date"))
        .when(start >= end, F.lit("start_date must be before end_date"))
        .when(end > as_of, F.lit("end_date must not be in the future"))
    )
    if max_days is not None:
        error = error.when(whole_days(start, end) > max_days, F.lit(f"range must not exceed {max_days} days"))
    return error


def resolve_windows(requests: DataFrame, as_of: Column | str, max_days: int | None = MAX_DAYS) -> DataFrame:
    """Adds `start_utc`, `end_utc` (half open), their ISO texts, and `error`, NULL for a valid request."""
    as_of = _as_ts(as_of)
    return _bounds(requests, as_of).withColumns({
        "start_iso": iso_utc(F.col("start_utc")),
        "end_iso": iso_utc(F.col("end_utc")),
        "error": _error(as_of, max_days),
    })


def require_valid(resolved: DataFrame) -> DataFrame:
    """`resolved` requests when all are valid; raises with the first error otherwise."""
    wrong = resolved.filter(F.col("error").isNotNull()).select("error").head(1)
    if wrong:
        raise ValueError(wrong[0]["error"])
    return resolved


def split_windows(requests: DataFrame, as_of: Column | str, max_days: int = MAX_DAYS) -> DataFrame:
    """Valid requests of any length as consecutive windows of at most `max_days`, numbered from 1.

    Given days are stepped in the request calendar, so every inner bound is an Eastern midnight; the outer bounds are
    the request's own instants, also in the hour that a clock change repeats.
    """
    as_of = _as_ts(as_of)
    valid = _bounds(requests, as_of).filter(_error(as_of, None).isNull())
    local_start = F.from_utc_timestamp("start_utc", REQUEST_ZONE)
    local_end = F.from_utc_timestamp("end_utc", REQUEST_ZONE)
    step = F.expr(f"INTERVAL {max_days} DAYS")
    starts = F.posexplode(F.sequence(local_start, local_end, step)).alias("at", "window_from")
    windows = valid.select(*requests.columns, "start_utc", "end_utc", local_end.alias("local_end"), starts)
    first, until = F.col("at") == 0, F.col("window_from") + step
    return windows.filter(first | (F.col("window_from") < F.col("local_end"))).select(
        *requests.columns,
        (F.col("at") + 1).alias("window_no"),
        F.when(first, F.col("start_utc")).otherwise(F.to_utc_timestamp("window_from", REQUEST_ZONE)).alias("start_utc"),
        F.when(until >= F.col("local_end"), F.col("end_utc")).otherwise(
            F.to_utc_timestamp(until, REQUEST_ZONE)
        ).alias("end_utc"),
    )


def preset_requests(accounts: DataFrame, as_of: Column | str) -> DataFrame:
    """One request per account and preset range, from so many days back until the day of `as_of`."""
    today = _as_ts(as_of).cast("date")
    presets = F.array(*[
        F.struct(F.lit(name).alias("preset"), title_day(F.date_sub(today, days)).alias("start_date"))
        for name, days in PRESET_DAYS.items()
    ])
    return accounts.select(ACCOUNT, F.inline(presets)).withColumn("end_date", title_day(today))


def dated(orders: DataFrame) -> DataFrame:
    """Order lines with their purchase day, null if it is unreadable."""
    orders = to_internal(orders)
    if "purchase_date_fmt" in orders.columns:
        return orders
    return orders.withColumn("purchase_date_fmt", purchase_day(F.col("purchase_date")))


def instant(purchase_date: Column, day: Column) -> Column:
    """When a line was bought, in microseconds: by its instant; if only its day is readable, the start of that day. Null without a day."""
    at = F.coalesce(F.try_to_timestamp(purchase_date.cast("string")), day.cast("timestamp"))
    return F.when(day.isNotNull(), F.unix_micros(at))


def _bins(windows: DataFrame, keys: Sequence[str], scratch: Scratch) -> IntervalJoin:
    return IntervalJoin(windows, F.unix_micros("start_utc"), F.unix_micros("end_utc"), keys, scratch)


def _at() -> Column:
    return instant(F.col("purchase_date"), F.col("purchase_date_fmt"))


def in_window(
    orders: DataFrame, windows: DataFrame, keys: Sequence[str] = (ACCOUNT,), scratch: Scratch | None = None, keep: bool = False
) -> DataFrame:
    """Order lines with every window they fall in, by purchase instant.

    Windows are listed by account and bin of time, two for each at most, so one account's lines spread over many join
    keys; bins that hold very many lines are split. The first and last day of all windows go to the scan as literals,
    with a day's margin as the written day may differ from the UTC day, so a table partitioned or sorted by day is read for those days only.
    Lines without a readable day are in no window; the quarantine lists them. With `keep`, lines that had to be moved are written, as
    the result is read more than once.
    """
    orders = dated(orders)
    span = windows.agg(F.date_sub(F.min("start_utc").cast("date"), 1).alias("first"), F.date_add(F.max("end_utc").cast("date"), 1).alias("last")).head()
    orders = orders.filter(F.col("purchase_date_fmt").between(F.lit(span["first"]), F.lit(span["last"])))
    scratch = scratch or Scratch(orders.sparkSession)
    bins = _bins(windows, keys, scratch)
    found = bins.join(orders, _at())
    own = [F.col(f"`{c}`") for c in found.columns if c not in keys]
    found = found.select(*own, *keys)
    return found if bins.small or not keep else scratch.table(found, "windowed")


def line_accounting(
    orders: DataFrame, windows: DataFrame, keys: Sequence[str] = (ACCOUNT,), scratch: Scratch | None = None
) -> DataFrame:
    """Lines per key that landed, are in a window, are outside all windows, or have no readable day.

    Every line is in exactly one of the last three.
    """
    orders = dated(orders)
    found = _bins(windows, keys, scratch or Scratch(orders.sparkSession)).inside(orders, _at())
    landed = orders.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("landed"), F.count(F.when(F.col("purchase_date_fmt").isNull(), 1)).alias("undated"))
    rows = landed.join(found.groupBy(*keys).agg(F.count(F.lit(1)).alias("in_window")), list(keys), "left").na.fill(0, ["in_window"])
    return rows.select(*keys, "landed", "in_window", (F.col("landed") - F.col("in_window") - F.col("undated")).alias("outside"), "undated")
