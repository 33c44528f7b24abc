from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyshelf import columns as C
from tallyshelf.operators import chunks, clean
from tallyshelf.operators.chunks import distinct_rows, distinct_table, merge_chunks, union_chunks
from tallyshelf.operators.clean import canonical_number, clean_orders, clean_stock, quarantine, require_columns
from tallyshelf.operators.known_lines import DIGEST, FILE, PART_SCHEMA, WRITTEN_DAY, parts_of
from tallyshelf.scratch import Scratch
from tests.tables import DAY, listed, orders, stock

NUMBERS = [
    ("", 0), (None, 0), ("nan", 0), ("NA", 0), ("abc", None), (" 5 ", 5), ("1e3", 1000), ("5d", None), ("1,234", None),
    ("-3", -3), (".5", 0.5), ("5.", 5), ("+7", 7), ("inf", None), ("1e5d", None), ("2.5E-1", 0.25), ("0x10", None),
    ("1e-999999999", None), ("12.3400", 12.34),
]


@pytest.mark.parametrize("column", ["item-price", "quantity"])
def test_number_texts(spark, column):
    place = {"item-price": 2, "quantity": 3}[column]
    rows = [["s", str(i), "1", "1"] for i in range(len(NUMBERS))]
    for row, (text, _) in zip(rows, NUMBERS):
        row[place] = text
    got = dict(listed(clean_orders(orders(spark, *rows)), "product_name", column.replace("-", "_")))
    for i, (text, want) in enumerate(NUMBERS):
        if text == "1e-999999999":
            assert not got[str(i)]
        else:
            assert got[str(i)] == (None if want is None else Decimal(str(want))), text


def test_numeric_source_columns(spark):
    df = spark.createDataFrame(
        [("s", "p", DAY, 1.5, 2), ("s", "p", DAY, float("nan"), None), ("s", "p", DAY, float("inf"), 1)],
        "sku string, `product-name` string, `purchase-date` string, `item-price` double, quantity int",
    )
    assert listed(clean_orders(df), "item_price", "quantity") == [
        (Decimal("1.5"), Decimal(2)), (Decimal(0), Decimal(0)), (None, Decimal(1)),
    ]


def test_stock_numbers(spark):
    got = clean_stock(stock(spark, ("a", "3"), ("b", None), ("c", "many")))
    assert listed(got, "afn_fulfillable_quantity") == [(Decimal(3),), (Decimal(0),), (None,)]


@pytest.mark.parametrize("text, day", [
    ("2024-11-25T23:59:00-08:00", date(2024, 11, 25)), ("2024-11-25T07:59:00+00:00", date(2024, 11, 25)),
    ("2024-11-25", date(2024, 11, 25)), ("junk", None), (None, None), ("2024-13-01T00:00:00", None),
])
def test_purchase_day_ignores_offset_and_survives_junk(spark, text, day):
    assert listed(clean_orders(orders(spark, ("s", "p", "1", "1", text))), "purchase_date_fmt") == [(day,)]


def test_null_tokens_and_leading_zeros(spark):
    got = clean_orders(orders(spark, ("NA", "p", "1", "1"), ("None", "", "1", "1"), ("0012", "null", "1", "1")))
    assert listed(got, "sku", "product_name") == [(None, "p"), (None, None), ("0012", None)]


def test_other_columns_pass_through(spark):
    df = orders(spark, ("s", "p", "1", "1")).withColumn("ship-city", F.lit("NA"))
    assert "ship-city" in clean_orders(df).columns


def test_missing_columns(spark):
    df = orders(spark, ("s", "p", "1", "1")).drop("sku", "item-price")
    assert C.missing_columns(df, C.SALES_ORDER_COLUMNS) == ["sku", "item-price"]
    with pytest.raises(ValueError, match="sku, item-price"):
        clean_orders(df)
    with pytest.raises(KeyError):
        require_columns(df, C.ON_HAND_ORDER_COLUMNS, KeyError)


def test_quarantine_names_every_reason(spark):
    got = quarantine(orders(spark, ("s", "p", "1", "1"), (None, "", "x", "y", "junk"), ("s", "p", "x", None)))
    assert listed(got, "reasons") == [
        (["sku_missing", "product_name_missing", "purchase_date_unreadable", "item_price_unreadable",
          "quantity_unreadable"],),
        (["item_price_unreadable"],),
    ]


def test_distinct_rows(spark):
    same = ("s", "p", "1.50", "1")
    df = orders(spark, same, same, ("s", "p", "1.5", "1"), ("s", None, "1", "1"), ("s", None, "1", "1"), ("s", "p", "x", "1"))
    assert distinct_rows(df).count() == 3


def test_fine_prices_stay_apart(spark):
    df = orders(spark, ("s", "p", "1.23456", "1"), ("s", "p", "1.23461", "1"), ("s", "p", "1.23456", "1.0"), ("s", "p", "", "1"))
    assert sorted(str(r[0]) for r in listed(distinct_rows(df), "item-price")) == ["", "1.23456", "1.23461"]


def test_equal_lines_of_two_accounts_stay(spark):
    df = orders(spark, ("s", "p", "1", "1", DAY, "ab"), ("s", "p", "1", "1", DAY, "cd"))
    assert distinct_rows(df).count() == 2


def test_chunks_are_matched_by_name(spark):
    a = spark.createDataFrame([("s", "1")], "sku string, quantity string")
    b = spark.createDataFrame([("1", "s", "x")], "quantity string, sku string, note string")
    assert listed(union_chunks([a, b]), "sku", "quantity", "note") == [("s", "1", None), ("s", "1", "x")]
    assert merge_chunks([a, a, b]).count() == 2


def test_doubles_are_unreadable_from_the_bound_on(spark):
    prices = [1.5, float("nan"), None, 9.999999999999998e18, -9.999999999999998e18, 1e19, -1e19, float("inf"), float("-inf")]
    # The float next to 10^19 is below it.
    for kind, least in (("double", {"5", "6", "7", "8"}), ("float", {"7", "8"})):
        rows = [("s", str(i), DAY, p, 1) for i, p in enumerate(prices)]
        df = spark.createDataFrame(rows, f"sku string, `product-name` string, `purchase-date` string, `item-price` {kind}, quantity int")
        held = {r.product_name: r.item_price for r in clean_orders(df).collect()}
        refused = {r.product_name for r in quarantine(df).collect() if "item_price_unreadable" in r.reasons}
        assert refused == {i for i, price in held.items() if price is None} == least


def test_each_check_of_the_quarantine_is_made_once_a_line(spark):
    df = orders(spark, ["s", "p", "abc", "1"])
    plan = quarantine(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("item_price_unreadable") == 1 and plan.count("AS date") <= 2


def test_plain_numbers_are_spelled_as_the_casts_spell_them(spark):
    texts = ["0", "0.0", "0.00", "0.000", "00", "1", "10", "1.", "1.5", "12.50", "12.50000000", "12.500000001", "012", "0.5", "+1", "-1", " 1", "1e3", "1.0e-9", "x", "", ".5",
             "123456789012345678", "1234567890123456789", "12345678901234567890", "123456789012345678.12345678", "1.2.3", "1\n", "NaN", "1,234", None]
    df = spark.createDataFrame([(t,) for t in texts], "n string")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            rows = df.select("n", canonical_number(df, "n").alias("fast"), clean._canonical(df, "n").alias("slow")).collect()
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")
        assert [(r.n, r.fast) for r in rows] == [(r.n, r.slow) for r in rows]


def test_sums_of_parts_are_those_of_both_halves_of_the_digests(spark):
    digests = [f"{i * 0x9E3779B97F4A7C15F39CC0605CEDC835 % (1 << 128):032x}" for i in range(1, 60)] + ["f" * 32] * 9
    lines = spark.createDataFrame([("f", "a", "d", x) for x in digests], f"{FILE} string, account_name string, {WRITTEN_DAY} string, {DIGEST} string")
    row = parts_of(lines).head()
    assert (row.part_lines, int(row.part_high), int(row.part_low)) == (len(digests), sum(int(x[:16], 16) for x in digests), sum(int(x[16:], 16) for x in digests))
    assert [f.dataType for f in parts_of(lines).schema][3:] == [f.dataType for f in PART_SCHEMA][2:]


@pytest.mark.parametrize("most", [1_000_000, 1])
def test_distinct_table_moves_only_rows_that_may_have_copies(spark, monkeypatch, most):
    """Copies, other spellings and nulls; beyond `most` shared hashes all rows are compared."""
    monkeypatch.setattr(chunks, "SHARED_HASHES", most)
    some = [(f"s{i}", "p", str(i), "1") for i in range(30)] + [("s1", "p", "1.00", "1.0"), ("s1", "p", "1", "1"), ("s2", "p", " 2", "1"), (None, "p", None, "1"), (None, "p", None, "1"), ("p", None, None, "1")]
    lines, moved = orders(spark, *some), []
    want = sorted(map(repr, distinct_rows(lines).collect()))
    monkeypatch.setattr(chunks, "distinct_rows", lambda df: moved.append(df.count()) or distinct_rows(df))
    got = distinct_table(lines, Scratch(spark), "landed")
    assert got.columns == lines.columns and sorted(map(repr, got.collect())) == want and len(want) == 32
    # A hash skips nulls, so one row shares that of another without being its copy.
    assert moved == [8 if most > 1 else 36]
    assert distinct_table(lines.limit(0), Scratch(spark), "landed").count() == 0
