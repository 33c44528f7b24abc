"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import queries, views
from tallyshelf import Scratch
from tallyshelf.columns import ACCOUNT
from tallyshelf.operators.clean import clean_orders
from tallyshelf.operators.copies import CHUNK, SPAN
from tallyshelf.operators.ranking import block_starts, rank_rows, sort_into_blocks
from tallyshelf.operators import intervals
from tallyshelf.operators.report_log import latest_ready
from tallyshelf.operators.requests import in_window, resolve_windows
from tallyshelf.operators.sku_sales import paid_orders, sales_by_sku, sku_rollup
from tallyshelf.scratch import shared_folder

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def typed_orders(spark):
    """Seller orders as a typed table, wider than any report needs."""
    path = f"{shared_folder(spark)}/typed-orders"
    df = views.orders_view(spark, SF).withColumnsRenamed({"product-name": "product_name", "item-price": "item_price",
                                                          "purchase-date": "purchase_date"})
    df.withColumn("ship_city", F.lit("x")).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_price_filter_and_columns_reach_the_scan(typed_orders):
    text = plan(sales_by_sku(clean_orders(paid_orders(typed_orders)), [ACCOUNT]))
    assert "GreaterThan(item_price,0.0)" in text
    assert "ship_city" not in text and "purchase_date" not in text
    assert text.count("FileScan") == 1


def test_the_roll_up_reads_orders_once_and_combines_before_its_shuffle(typed_orders):
    text = plan(sku_rollup(clean_orders(typed_orders), [ACCOUNT]))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "partial_sum" in text


def test_no_python_and_no_cross_join(spark):
    for name in ("sales_report", "on_hand_report", "raw_data", "report_index", "window_filter", "resolve_report", "dedup_chunks"):
        text = plan(queries.registered()[name](spark, SF))
        assert not any(word in text for word in ("Python", "Cartesian", "BroadcastNestedLoop")), name


def test_a_report_has_no_window_over_its_rows(spark):
    text = plan(queries.registered()["sales_report"](spark, SF))
    assert text.count("Window") == 0


def test_latest_ready_combines_before_its_shuffle(spark):
    text = plan(latest_ready(views.log_view(spark, SF)))
    assert "Window" not in text and "partial_min" in text and text.count("Exchange") == 1


def test_windows_are_joined_by_account_and_bin(spark, typed_orders):
    asked = spark.createDataFrame([("BUILDING", "1-1-1998", "1-31-1998")], f"{ACCOUNT} string, start_date string, end_date string")
    lines = clean_orders(typed_orders)
    text = plan(in_window(lines, resolve_windows(asked, "2002-01-01").select(ACCOUNT, "start_utc", "end_utc")))
    join = next(line for line in text.splitlines() if "Join" in line)
    keys = join[join.index("["):join.index("Inner")]
    assert keys.count(ACCOUNT) == 2 and keys.count("interval_bin") == 2 and "BroadcastNestedLoop" not in text


def test_many_windows_are_not_broadcast(spark, typed_orders, monkeypatch):
    """The table of windows packs to little, whatever its rows would take in memory. What is broadcast are the few heavy keys."""
    monkeypatch.setattr(intervals, "BROADCAST_INTERVALS", 100)
    starts = spark.range(100).select(F.lit("BUILDING").alias(ACCOUNT), F.timestamp_seconds(F.col("id") * 86400 + 883612800).alias("start_utc"))
    windows = starts.withColumn("end_utc", F.col("start_utc") + F.expr("INTERVAL 1 DAY"))
    text = plan(in_window(clean_orders(typed_orders), windows))
    assert "SortMergeJoin" in text and text.count("BroadcastExchange") <= 2 and text.count("heavy_parts") >= text.count("BroadcastExchange")


def test_days_outside_all_windows_are_not_read(spark, typed_orders):
    path = f"{shared_folder(spark)}/orders-by-day"
    by_day = typed_orders.withColumn("purchase_date_fmt", F.substring_index("purchase_date", "T", 1).cast("date"))
    by_day.coalesce(1).write.mode("overwrite").partitionBy("purchase_date_fmt").parquet(path)
    asked = spark.createDataFrame([("BUILDING", "1-1-1998", "1-31-1998")], f"{ACCOUNT} string, start_date string, end_date string")
    windows = resolve_windows(asked, "2002-01-01").select(ACCOUNT, "start_utc", "end_utc")
    kept = in_window(spark.read.parquet(path), windows)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    scan = next(line for line in plan(kept).splitlines() if "PartitionFilters" in line)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert ">= 1997-12-31" in filters and "<= 1998-02-01" in filters
    assert kept.count() == in_window(typed_orders, windows).count() > 0
    assert in_window(typed_orders, windows.filter("false")).count() == 0


def test_lines_are_written_only_if_the_window_join_moves_them(spark, typed_orders, monkeypatch):
    windows = spark.createDataFrame([("BUILDING",)], [ACCOUNT]).selectExpr(ACCOUNT, "timestamp'1998-01-01' AS start_utc", "timestamp'1998-02-01' AS end_utc")
    lines = clean_orders(typed_orders)
    few = in_window(lines, windows, keep=True)
    monkeypatch.setattr(intervals, "BROADCAST_INTERVALS", 0)
    many = in_window(lines, windows, keep=True)
    assert "windowed-" not in "".join(few.inputFiles()) and "windowed-" in "".join(many.inputFiles())
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.select(few.columns).collect())) != []


def test_wide_decimals_sort_by_their_keys(spark):
    """Whole numbers, fractions, negative and very large ones and null, as the decimals themselves sort, and unchanged."""
    texts = ["0", "1", "2.5", "2.50000001", "-2.5", "-3", "-0.00000001", "8999999999999999.5", "9000000000000000", "-8999999999999999.5", "-9000000000000000.5",
             "-9000000000000000", "123456789012345678901234567.12345678", "123456789012345678901234567.12345679", "-123456789012345678901234567.5", None]
    rows = spark.createDataFrame([("a", t) for t in texts], f"{ACCOUNT} string, t string").select(ACCOUNT, F.col("t").cast("decimal(37,8)").alias("n"))
    for order, plain in (([F.col("whole n").desc_nulls_last(), F.col("rest n").desc_nulls_last()], F.col("n").desc_nulls_last()),
                         ([F.col("whole n").asc(), F.col("rest n").asc()], F.col("n").asc())):
        ordered = sort_into_blocks(rows, [ACCOUNT], order, Scratch(spark), ("n",))
        assert ordered.schema["n"].dataType == rows.schema["n"].dataType
        assert [r.n for r in ordered.orderBy("block", "seat").collect()] == [r.n for r in rows.orderBy(plain).collect()]


def test_positions_equal_a_window_over_the_group(many_blocks):
    spark = many_blocks
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("a"), F.col("id") % 40)).alias(ACCOUNT),
        (F.xxhash64("id") % 50).alias("units"), F.col("id").alias("sku"),
    )
    order = [F.col("units").desc(), F.col("sku").asc()]
    ordered = sort_into_blocks(rows, [ACCOUNT], order, Scratch(spark))
    assert ordered.filter(F.col(ACCOUNT) == "hot").select("block").distinct().count() > 1
    got = rank_rows(ordered, block_starts(ordered, [ACCOUNT]), [ACCOUNT])
    want = rows.withColumn("report_rank", F.row_number().over(Window.partitionBy(ACCOUNT).orderBy(*order)).cast("bigint"))
    assert got.count() == 5000
    assert got.exceptAll(want.select(got.columns)).count() == 0


def test_copies_are_written_out_whole_by_several_tasks(many_blocks):
    rows = many_blocks.createDataFrame(
        [("hot", 1, 150_000), ("hot", 2, 1), ("a", 1, CHUNK), ("a", 2, CHUNK + 1), ("b", 1, 2 * CHUNK * SPAN)],
        f"{ACCOUNT} string, n int, copies bigint",
    )
    ordered = sort_into_blocks(rows, [ACCOUNT], [F.col("n").asc()], Scratch(many_blocks))
    got = rank_rows(ordered, block_starts(ordered, [ACCOUNT]), [ACCOUNT])
    assert ordered.filter(F.col(ACCOUNT) == "hot").select("block").distinct().count() > 1
    spans = got.groupBy(ACCOUNT, "n").agg(F.count("*"), F.min("report_rank"), F.max("report_rank"), F.countDistinct("report_rank"))
    assert sorted(tuple(r) for r in spans.collect()) == [
        ("a", 1, CHUNK, 1, CHUNK, CHUNK), ("a", 2, CHUNK + 1, CHUNK + 1, 2 * CHUNK + 1, CHUNK + 1),
        ("b", 1, 2 * CHUNK * SPAN, 1, 2 * CHUNK * SPAN, 2 * CHUNK * SPAN),
        ("hot", 1, 150_000, 1, 150_000, 150_000), ("hot", 2, 1, 150_001, 150_001, 1),
    ]
