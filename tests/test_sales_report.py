import random

import pytest
from pyspark.sql import functions as F

from tallyshelf import ZeroSalesError, account_sales_report, sales_display, sales_report, with_bars
from tallyshelf.columns import ACCOUNT
from tallyshelf.operators.copies import CHUNK
from tallyshelf.operators.sku_sales import sales_by_sku
from tallyshelf.plans.sales_report import gates, line_sums
from tests.tables import DAY, listed, orders, ranked, stock


def total(units, revenue):
    return ("Grand Total", "", units, revenue, None)


def test_products_totals_and_order(spark):
    o = orders(
        spark, ("b", "pb", "10", "1"), ("a", "pa", "2.5", "1"), ("a", "pa", "2.5", "2"), ("c", "pa", "1", "3"),
        ("d", "pd", "0", "9"), (None, "px", "5", "1"), ("x", None, "5", "1"),
    )
    report = sales_report(o, stock(spark, ("a", "7"), ("c", "many")))
    assert ranked(report.summary) == [
        total(7.0, 16.0), ("a", "pa", 3.0, 5.0, 7.0), ("c", "pa", 3.0, 1.0, 0.0), ("b", "pb", 1.0, 10.0, 0.0),
    ]


def test_names_sort_by_code_point(spark):
    o = orders(spark, *[(f"s{i}", n, "1", "1") for i, n in enumerate(["é", "b", "B", "a"])])
    assert [r[1] for r in ranked(sales_report(o, stock(spark, ("z", "1"))).summary)] == ["", "B", "a", "b", "é"]


def test_one_product_stays_below_its_total(spark):
    o = orders(spark, ("a", "pa", "1", "1"))
    assert [r[0] for r in ranked(sales_report(o, stock(spark, ("a", "1"))).summary)] == ["Grand Total", "a"]


def test_unreadable_quantities_sum_to_zero(spark):
    o = orders(spark, ("a", "pa", "1", "x"))
    assert ranked(sales_report(o, stock(spark, ("a", "1"))).summary)[1] == ("a", "pa", 0.0, 1.0, 1.0)


def test_repeated_stock_repeats_the_product_and_the_total(spark):
    o, s = orders(spark, ("a", "pa", "2", "1")), stock(spark, ("a", "1"), ("a", "5"), ("a", "1"))
    assert ranked(sales_report(o, s).summary) == [
        total(3.0, 6.0), ("a", "pa", 1.0, 2.0, 1.0), ("a", "pa", 1.0, 2.0, 1.0), ("a", "pa", 1.0, 2.0, 5.0),
    ]
    summed = sales_report(o, s, inventory_policy="sum_per_sku")
    assert ranked(summed.summary) == [total(1.0, 2.0), ("a", "pa", 1.0, 2.0, 7.0)]
    with pytest.raises(ValueError):
        sales_report(o, s, inventory_policy="first")


def test_more_copies_than_one_sorted_row_carries(many_blocks):
    spark = many_blocks
    n = 3 * CHUNK + 7
    s = stock(spark, *[("a", "4")] * n, ("b", "1"))
    rows = ranked(sales_report(orders(spark, ("a", "pa", "2", "1"), ("b", "pb", "1", "9")), s).summary)
    assert rows == [total(n + 9.0, 2.0 * n + 1), ("b", "pb", 9.0, 1.0, 1.0)] + [("a", "pa", 1.0, 2.0, 4.0)] * n


def test_date_range_covers_free_lines_and_title(spark):
    o = orders(
        spark, ("a", "p", "1234.5", "2", "2024-11-03T00:00:00Z"), ("b", "p", "0", "1", "2024-11-01T00:00:00Z"),
        ("b", "p", "0", "1", "junk"),
    )
    row = sales_report(o, stock(spark, ("a", "1"))).index.collect()[0]
    assert (str(row.start_date), str(row.end_date), row.days) == ("2024-11-01", "2024-11-03", 2)
    assert row.report_name == "AB Sales 11-01-2024 through 11-03-2024 (2 units, $1,234.50)"
    assert row.status == "OK"


@pytest.mark.parametrize("last, dates", [("2024-11-01", "11-01-2024"), ("2024-11-02", "11-01-2024"),
                                         ("2024-11-03", "11-01-2024 through 11-03-2024")])
def test_title_dates(spark, last, dates):
    o = orders(spark, ("a", "p", "1", "1.5", "2024-11-01"), ("a", "p", "1", "1", last))
    row = sales_report(o, stock(spark, ("a", "1"))).index.collect()[0]
    assert row.report_name == f"AB Sales {dates} (2.5 units, $2.00)"


@pytest.mark.parametrize("quantity, text", [("12", "12"), ("2.5", "2.5"), ("12345678.25", "12345678.25"), ("10.10", "10.1"),
                                            ("x", "0"), ("1e7", "10000000")])
def test_units_in_titles(spark, quantity, text):
    report = sales_report(orders(spark, ("a", "p", "1", quantity)), stock(spark, ("a", "1")))
    assert f"({text} units, $1.00)" in report.index.collect()[0].report_name


@pytest.mark.parametrize("account", ["", None])
def test_title_without_account(spark, account):
    o = orders(spark, ("a", "p", "1", "1", "2024-11-01", account))
    report = sales_report(o, stock(spark, ("a", "6", "")))
    assert report.index.collect()[0].report_name == "Sales 11-01-2024 (1 units, $1.00)"
    assert ranked(report.summary)[1] == ("a", "p", 1.0, 1.0, 6.0)


def test_title_of_an_account_whose_name_is_in_the_words(spark):
    o = orders(spark, ("a", "p", "1", "1", "2024-11-01", "sa"))
    assert sales_report(o, stock(spark, ("a", "1"))).index.collect()[0].report_name.startswith("SA Sales ")


def test_gates(spark):
    o = orders(
        spark, ("a", "p", "5", "1", DAY, "good"), ("a", "p", "0", "1", DAY, "free"), ("a", "p", "x", "1", DAY, "text"),
        ("a", "p", "5", "1", DAY, "even"), ("b", "p", "-5", "1", DAY, "even"), ("a", "p", "-5", "1", DAY, "refund"),
    )
    asked = spark.createDataFrame([(a,) for a in ("good", "free", "text", "even", "refund", "idle")], f"{ACCOUNT} string")
    report = sales_report(o, stock(spark, ("a", "1")), requested=asked)
    assert dict(listed(report.index, ACCOUNT, "status")) == {
        "good": "OK", "free": "ZERO_REVENUE", "text": "ZERO_REVENUE", "even": "ZERO_REVENUE",
        "refund": "NO_POSITIVE_SALES", "idle": "NO_ORDERS",
    }
    assert {r[0] for r in listed(report.summary, ACCOUNT)} == {"good"}
    assert {r[0] for r in listed(report.raw_data, ACCOUNT)} == {"good"}
    assert {r.status: r.revenue for r in report.index.collect()}["NO_POSITIVE_SALES"] is None


def test_repeated_stock_does_not_hide_a_zero_sum(spark):
    o = orders(spark, ("a", "p", "5", "1"), ("b", "p", "-5", "1"))
    s = stock(spark, ("a", "1"), ("a", "2"))
    assert listed(sales_report(o, s).index, "status") == [("ZERO_REVENUE",)]


def test_one_account_raises(spark):
    s = stock(spark, ("a", "1"))
    for o in (orders(spark, ("a", "p", "0", "1")), orders(spark, ("a", "p", "1", "1")).filter("false")):
        with pytest.raises(ZeroSalesError):
            account_sales_report(o, s, "ab")
    plain = orders(spark, ("a", "p", "1", "1")).drop(ACCOUNT)
    report = account_sales_report(plain, s.drop(ACCOUNT), "cd")
    assert report.index.collect()[0].report_name.startswith("CD Sales")


def test_no_stock_rows(spark):
    o = orders(spark, ("a", "p", "1", "1"))
    assert ranked(sales_report(o, stock(spark, ("a", "1")).filter("false")).summary)[1] == ("a", "p", 1.0, 1.0, 0.0)


def test_raw_data_is_cleaned_source_rows(spark):
    o = orders(spark, ("a", "p", None, "x"), ("a", "p", "2", "3")).withColumn("city", F.lit("here"))
    raw = sales_report(o, stock(spark, ("a", "1"))).raw_data
    assert set(raw.columns) == {
        ACCOUNT, "sku", "product_name", "purchase_date", "item_price", "quantity", "city", "purchase_date_fmt",
    }
    assert sorted(listed(raw, "item_price", "quantity"), key=str) == [(0.0, None), (2.0, 3.0)]


def _random_orders(spark, accounts, n=400, seed=7):
    rng = random.Random(seed)
    rows = [
        (f"s{rng.randrange(25)}", f"p{rng.randrange(4)}", str(rng.choice([0, 1, 2.25, 9.99])), str(rng.randrange(1, 4)),
         f"2024-11-{rng.randrange(1, 28):02d}T00:00:00Z", rng.choice(accounts))
        for _ in range(n)
    ]
    return rows, orders(spark, *rows)


def _expected(rows, units):
    """Brute force over one account's rows: (sku, product, units, revenue, stock) in order."""
    sums = {}
    for sku, product, price, quantity, *_ in rows:
        if float(price) > 0:
            a = sums.setdefault((sku, product), [0, 0])
            a[0] += int(quantity)
            a[1] += round(float(price) * 100)
    out = [(s, p, float(q), r / 100, float(units.get(s, 0))) for (s, p), (q, r) in sums.items()]
    out.sort(key=lambda r: (-r[2], r[1], r[0]))
    return [total(sum(r[2] for r in out), round(sum(r[3] for r in out), 2))] + out


def test_brute_force_with_a_hot_account_over_many_blocks(many_blocks):
    spark = many_blocks
    rows, o = _random_orders(spark, ["hot"] * 8 + ["x", "y"])
    s = stock(spark, *[(f"s{i}", str(i), a) for i in range(20) for a in ("hot", "x", "y")])
    report = sales_report(o.repartition(7), s)
    for account in ("hot", "x", "y"):
        mine = [r for r in rows if r[5] == account]
        got = ranked(report.summary.filter(F.col(ACCOUNT) == account))
        assert [(*r[:3], round(r[3], 2), r[4]) for r in got] == _expected(mine, {f"s{i}": i for i in range(20)})
        alone = account_sales_report(o, s.filter(F.col(ACCOUNT) == account), account)
        assert ranked(alone.summary) == got


def test_report_per_account_and_other_keys(spark):
    rows, o = _random_orders(spark, ["x"], 60)
    o = o.withColumn("week", F.when(F.col("purchase-date") < "2024-11-15", 1).otherwise(2))
    report = sales_report(o, stock(spark, ("s1", "3", "x")), by=(ACCOUNT, "week"))
    for week in (1, 2):
        mine = [r for r in rows if (r[4] < "2024-11-15") == (week == 1)]
        assert ranked(report.summary.filter(F.col("week") == week)) == _expected(mine, {"s1": 3})


def test_bars_and_display(spark):
    o = orders(spark, ("a", "pa", "1000", "11"), ("b", "pb", "1", "1"), ("c", "pc", "0.5", "6"))
    summary = sales_report(o, stock(spark, ("a", "1"), ("b", "0"))).summary
    bars = {r.sku: (r.units_sold_bar, r.revenue_bar, r.remaining_units_bar) for r in with_bars(summary).collect()}
    assert bars == {"Grand Total": (None, None, None), "a": (1.0, 1.0, None), "b": (0.0, 0.0, None), "c": (0.5, 0.0, None)}
    shown = {r.sku: (r.units_sold, r.revenue, r.remaining_units) for r in sales_display(summary).collect()}
    assert shown == {"Grand Total": ("18", "$1,001.50", None), "a": ("11", "$1,000.00", "1"), "b": ("1", "$1.00", "0"),
                     "c": ("6", "$0.50", "0")}


def test_sales_by_sku_keeps_negative_and_free_lines_out(spark):
    from tallyshelf.operators.clean import clean_orders
    o = orders(spark, ("a", "p", "2", "1"), ("a", "p", "-2", "1"), ("a", "p", "0", "5"))
    assert [(float(r.units_sold), float(r.revenue)) for r in sales_by_sku(clean_orders(o), [ACCOUNT]).collect()] == [(1.0, 2.0)]


def test_display_rounds_halves_away_from_zero(spark):
    o = orders(spark, ("a", "pa", "0.125", "2.5"), ("b", "pb", "1", "-2.5"))
    shown = {r.sku: (r.units_sold, r.revenue) for r in sales_display(sales_report(o, stock(spark, ("a", "1"))).summary).collect()}
    assert shown["a"] == ("3", "$0.13") and shown["b"] == ("-3", "$1.00")


def test_raw_data_alone_needs_no_roll_up(spark):
    lines = orders(
        spark, ("s1", "p", "2", "1"), ("s1", "p", "0", "1", DAY, "free"), ("s1", "p", "abc", "1", DAY, "junk"), ("None", "p", "5", "1", DAY, "unnamed"),
        ("s1", "p", "-3", "1", DAY, "back"), ("s1", "", "4", "1", DAY, "mixed"), ("s1", "p", "1", "1", DAY, "mixed"), ("s1", "p", "2", "1", "junk", "undated"))
    report = sales_report(lines, stock(spark, ("s1", "5")))
    alone = sorted(map(repr, report.raw_data.collect()))
    assert "rollup" not in report.__dict__
    again = sales_report(lines, stock(spark, ("s1", "5")))
    again.summary.collect()
    assert alone == sorted(map(repr, again.raw_data.collect())) and len(alone) == 4
    gate = lambda df: sorted(map(repr, gates(df, ["account_name"]).collect()))
    assert gate(line_sums(again.lines, ["account_name"])) == gate(again.rollup)
