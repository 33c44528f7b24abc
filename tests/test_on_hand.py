import pytest
from pyspark.sql import functions as F

from tallyshelf import on_hand_index, on_hand_report, with_bars
from tallyshelf.plans.presentation import ON_HAND_BARS
from tests.tables import DAY, listed, orders, stock


def shelf(report):
    return listed(report.orderBy("account_name", "report_rank"), "sku", "on_hand", "received", "report_rank")


def test_received_units_and_order(spark):
    o = orders(spark, ("a", "p", "0", "2"), ("a", "q", "5", "1"), ("c", "p", "1", "4"), (None, "p", "1", "9"), ("b", "p", "1", "x"))
    s = stock(spark, ("a", "3"), ("b", "0"), ("c", "0"), ("d", "3"), ("e", None), ("f", "many"), (None, "1"))
    assert shelf(on_hand_report(o, s)) == [
        ("a", 3.0, 6.0, 1), ("d", 3.0, 3.0, 2), (None, 1.0, 1.0, 3), ("c", 0.0, 4.0, 4),
    ]


def test_repeated_stock_is_kept(many_blocks):
    o = orders(many_blocks, ("a", "p", "1", "1"))
    s = stock(many_blocks, *[("a", "2")] * 600, ("b", "9"))
    rows = shelf(on_hand_report(o, s))
    assert rows[0] == ("b", 9.0, 9.0, 1)
    assert rows[1:] == [("a", 2.0, 3.0, i) for i in range(2, 602)]


def test_accounts_stay_apart(spark):
    o = orders(spark, ("a", "p", "1", "1", DAY, "ab"))
    s = stock(spark, ("a", "1", "ab"), ("a", "1", "cd"))
    assert shelf(on_hand_report(o, s)) == [("a", 1.0, 2.0, 1), ("a", 1.0, 1.0, 1)]


def test_columns_and_missing_columns(spark):
    o, s = orders(spark, ("a", "p", "1", "1")), stock(spark, ("a", "1"))
    assert on_hand_report(o, s).columns == ["account_name", "sku", "asin", "product_name", "on_hand", "received", "report_rank"]
    with pytest.raises(KeyError):
        on_hand_report(o, s.drop("asin"))
    with pytest.raises(KeyError):
        on_hand_report(o.drop("quantity"), s)


def test_titles(spark):
    accounts = spark.createDataFrame([("ab",), ("",), (None,)], "account_name string")
    titles = listed(on_hand_index(accounts, F.lit("2024-11-25").cast("date")), "report_name")
    assert titles == [("AB On Hand 11-25-2024",), ("On Hand 11-25-2024",), ("On Hand 11-25-2024",)]


def test_bars(spark):
    s = stock(spark, ("a", "3"), ("b", "1"))
    report = on_hand_report(orders(spark, ("b", "p", "1", "4")), s)
    assert sorted(listed(with_bars(report, ON_HAND_BARS), "sku", "on_hand_bar", "received_bar")) == [
        ("a", 1.0, 0.5), ("b", 0.0, 1.0),
    ]
