"""Purchase days, request days and report windows. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The calendar that request dates are given in, and their formats.
REQUEST_ZONE = "US/Eastern"
REQUEST_DAY_FORMAT = "M-d-yyyy"
REQUEST_DAY_PATTERN = r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"
TITLE_DAY_FORMAT = "MM-dd-yyyy"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ssxxx"


def purchase_day(c: Column) -> Column:
    """Calendar day as written: the text before 'T', whatever its offset. NULL for junk."""
    return F.substring_index(c.cast("string"), "T", 1).try_cast("date")


def request_day(c: Column) -> Column:
    """A request date given as m-d-yyyy with '-', '/' or '.'; NULL when it is not one."""
    dashed = F.regexp_replace(c, "[/.]", "-")
    return F.when(dashed.rlike(REQUEST_DAY_PATTERN), F.try_to_date(dashed, REQUEST_DAY_FORMAT))


def eastern_midnight_utc(day: Column) -> Column:
    return F.to_utc_timestamp(day.cast("timestamp"), REQUEST_ZONE)


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, ISO_FORMAT)


def whole_days(start: Column, end: Column) -> Column:
    """Whole elapsed 24-hour days, rounded down."""
    return F.floor((F.unix_micros(end) - F.unix_micros(start)) / F.lit(86_400_000_000)).cast("int")


def title_day(c: Column) -> Column:
    return F.date_format(c, TITLE_DAY_FORMAT)
