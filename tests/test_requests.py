import pytest
from pyspark.sql import functions as F

from tallyshelf.columns import ACCOUNT
from tallyshelf.operators.requests import in_window, preset_requests, require_valid, resolve_windows, split_windows
from tests.tables import listed, orders

NOW = "2024-11-25T12:00:00"


def asked(spark, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], f"{ACCOUNT} string, start_date string, end_date string")


def one(spark, start, end, account="ab", as_of=NOW):
    return resolve_windows(asked(spark, (account, start, end)), as_of).collect()[0]


@pytest.mark.parametrize("text", ["11-5-2024", "11/05/2024", "11.5.2024", "11/5.2024", "11-05-2024"])
def test_date_spellings(spark, text):
    row = one(spark, text, "11-06-2024")
    assert (row.start_iso, row.end_iso, row.error) == ("2024-11-05T05:00:00+00:00", "2024-11-06T05:00:00+00:00", None)


def test_default_is_the_last_day(spark):
    row = one(spark, None, None)
    assert (row.start_iso, row.end_iso, row.error) == ("2024-11-24T12:00:00+00:00", "2024-11-25T12:00:00+00:00", None)


@pytest.mark.parametrize("start, end, account, error", [
    ("11-20-2024", "11-20-2024", "ab", "before"), ("11-21-2024", "11-20-2024", "ab", "before"),
    ("11-20-2024", "11-26-2024", "ab", "future"), ("junk", "11-20-2024", "ab", "start_date is not"),
    ("11-20-24", "11-21-2024", "ab", "start_date is not"), ("11-20-2024", "13-20-2024", "ab", "end_date is not"),
    ("10-01-2024", "11-20-2024", "ab", "exceed"), ("11-20-2024", "11-21-2024", None, "missing"),
    ("11-20-2024", "11-21-2024", "", "missing"),
])
def test_refused(spark, start, end, account, error):
    assert error in one(spark, start, end, account).error


def test_the_limit_counts_whole_days(spark):
    assert one(spark, "10-25-2024", None).error is None  # 31 days 8 hours
    assert one(spark, "10-24-2024", None).error is not None  # 32 days 8 hours
    assert one(spark, "10-25-2024", None, as_of="2024-11-26T03:59:00").error is None  # 31 days 23:59


def test_days_across_a_clock_change(spark):
    row = one(spark, "3-10-2024", "3-11-2024")
    assert (row.start_iso, row.end_iso) == ("2024-03-10T05:00:00+00:00", "2024-03-11T04:00:00+00:00")


def test_require_valid(spark):
    good, bad = ("ab", "11-20-2024", "11-21-2024"), ("ab", "11-21-2024", "11-20-2024")
    assert require_valid(resolve_windows(asked(spark, good), NOW)).count() == 1
    with pytest.raises(ValueError, match="before"):
        require_valid(resolve_windows(asked(spark, good, bad), NOW))


def test_split(spark):
    rows = split_windows(asked(spark, ("ab", "1-1-2024", "3-5-2024")), NOW).orderBy("window_no").collect()
    assert [(r.window_no, str(r.start_utc), str(r.end_utc)) for r in rows] == [
        (1, "2024-01-01 05:00:00", "2024-02-01 05:00:00"), (2, "2024-02-01 05:00:00", "2024-03-03 05:00:00"),
        (3, "2024-03-03 05:00:00", "2024-03-05 05:00:00"),
    ]


@pytest.mark.parametrize("now", ["2024-11-03T05:30:00", "2024-11-03T06:30:00"])
def test_split_ends_in_the_repeated_hour(spark, now):
    rows = split_windows(asked(spark, ("ab", "11-1-2024", None), ("ab", None, None)), now).orderBy("start_utc").collect()
    assert [str(r.end_utc) for r in rows] == [now.replace("T", " ")] * 2
    assert [str(r.start_utc) for r in rows] == ["2024-11-01 04:00:00", now.replace("T0", " 0").replace("-03 ", "-02 ")]


def test_split_of_an_exact_multiple_has_no_empty_window(spark):
    assert split_windows(asked(spark, ("ab", "1-1-2024", "3-3-2024")), NOW).count() == 2


def test_split_leaves_refused_requests_out(spark):
    assert split_windows(asked(spark, ("ab", "1-2-2024", "1-1-2024"), ("", None, None)), NOW).count() == 0


def test_every_split_window_passes_the_limit(spark):
    windows = split_windows(asked(spark, ("ab", "1-1-2010", "11-1-2024")), NOW)
    ends = windows.select((F.unix_timestamp("end_utc") - F.unix_timestamp("start_utc")).alias("s"))
    assert ends.agg(F.max("s")).collect()[0][0] < 32 * 86400
    assert windows.agg(F.sum(F.unix_timestamp("end_utc") - F.unix_timestamp("start_utc"))).collect()[0][0] == (
        one(spark, "1-1-2010", "11-1-2024").end_utc - one(spark, "1-1-2010", "11-1-2024").start_utc).total_seconds()


def test_presets(spark):
    accounts = spark.createDataFrame([("ab",)], f"{ACCOUNT} string")
    assert listed(preset_requests(accounts, NOW), "preset", "start_date", "end_date") == [
        ("today", "11-25-2024", "11-25-2024"), ("one_month_ago", "10-26-2024", "11-25-2024"),
        ("two_months_ago", "09-26-2024", "11-25-2024"), ("three_months_ago", "08-27-2024", "11-25-2024"),
    ]


def test_lines_in_windows_by_instant(spark):
    dates = [
        "2024-11-05T04:59:59+00:00", "2024-11-05T05:00:00+00:00", "2024-11-05T23:30:00-08:00", "2024-11-06T00:30:00+05:00",
        "2024-11-06T04:59:59Z", "2024-11-06T05:00:00Z", "junk", None,
    ]
    o = orders(spark, *[(str(i), "p", "1", "1", d) for i, d in enumerate(dates)])
    windows = resolve_windows(asked(spark, ("ab", "11-5-2024", "11-6-2024"), ("cd", "11-5-2024", "11-6-2024")), NOW)
    kept = in_window(o, windows.select(ACCOUNT, "start_utc", "end_utc"))
    # 2024-11-05 23:30 at -08:00 is the next day's 07:30 UTC; 00:30 at +05:00 is the day before, 19:30 UTC.
    assert sorted(r[0] for r in listed(kept, "sku")) == ["1", "3", "4"]


def test_overlapping_windows_each_get_the_line(spark):
    o = orders(spark, ("a", "p", "1", "1", "2024-11-05T12:00:00Z"))
    windows = resolve_windows(asked(spark, ("ab", "11-4-2024", "11-6-2024"), ("ab", "11-5-2024", "11-7-2024")), NOW)
    assert in_window(o, windows.select(ACCOUNT, "start_utc", "end_utc")).count() == 2
