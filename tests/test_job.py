from pyspark.sql import functions as F

from tallyshelf import Scratch
from tallyshelf.columns import ACCOUNT, INVENTORY_REPORT, ORDERS_REPORT
from tallyshelf.plans.daily_job import run_daily_job
from tallyshelf.scratch import shared_folder
from tallyshelf.sinks.tables import write_partitions
from tallyshelf.sources.flat_files import write_flat_files
from tests.tables import listed, orders, stock

NOW = "2024-11-25T12:00:00"
ORDERS = [
    ("a", "pa", "2.50", "1", "2024-11-10T12:00:00Z", "ab"), ("a", "pa", "2.50", "1", "2024-11-10T12:00:00Z", "ab"),
    ("b", "pb", "4", "2", "2024-11-11T12:00:00Z", "ab"), ("b", "pb", "x", "2", "2024-11-11T12:00:00Z", "ab"),
    ("a", "pa", "9", "1", "2024-10-01T12:00:00Z", "ab"), ("z", "pz", "0", "1", "2024-11-10T12:00:00Z", "cd"),
]


def land(spark, folder):
    write_flat_files(orders(spark, *ORDERS), f"{folder}/{ORDERS_REPORT}", (ACCOUNT,), "gzip")
    write_flat_files(stock(spark, ("a", "7"), ("z", "3", "cd")), f"{folder}/{INVENTORY_REPORT}", (ACCOUNT,))


def asked(spark, *rows):
    return spark.createDataFrame(list(rows), f"{ACCOUNT} string, start_date string, end_date string")


def test_files_to_reports_twice(spark, tmp_path):
    out = str(tmp_path / "out")
    land(spark, tmp_path / "landing")
    late = tmp_path / "landing" / ORDERS_REPORT / f"{ACCOUNT}=cd" / "late.txt"
    late.write_text("quantity\tsku\tproduct-name\titem-price\tpurchase-date\n1\tz\tpz\t0\t2024-11-10T12:00:00Z\n1\t2\t3\t4\t5\t6\n")
    requests = asked(spark, ("ab", "11-01-2024", "11-20-2024"), ("cd", "11-01-2024", "11-20-2024"),
                     ("ef", "11-01-2024", "11-20-2024"), ("ab", "11-20-2024", "11-01-2024"))
    for _ in range(2):
        run_daily_job(spark, str(tmp_path / "landing"), requests, NOW, out)
        summary = spark.read.parquet(f"{out}/summary")
        assert listed(summary.orderBy("report_rank"), "sku", "product-name", "units sold", "revenue", "remaining units") == [
            ("Grand Total", "", 3.0, 6.5, None), ("b", "pb", 2.0, 4.0, 0.0), ("a", "pa", 1.0, 2.5, 7.0),
        ]
        raw = spark.read.parquet(f"{out}/raw_data")
        assert raw.count() == 3 and {"item-price", "purchase-date-fmt"} <= set(raw.columns)
        index = spark.read.parquet(f"{out}/report_index")
        assert sorted(listed(index, ACCOUNT, "status")) == [("AB", "OK"), ("CD", "ZERO_REVENUE"), ("EF", "NO_ORDERS")]
        assert listed(spark.read.parquet(f"{out}/quarantine"), "item_price") == [("x",)]
        assert listed(spark.read.parquet(f"{out}/rejected_lines"), ACCOUNT, "line") == [("CD", "1\t2\t3\t4\t5\t6")]
        assert listed(spark.read.parquet(f"{out}/refused_requests"), ACCOUNT, "end_date") == [("AB", "11-01-2024")]
        on_hand = spark.read.parquet(f"{out}/on_hand").orderBy(ACCOUNT, "report_rank")
        assert listed(on_hand, ACCOUNT, "sku", "on-hand", "received") == [("AB", "a", 7.0, 9.0), ("CD", "z", 3.0, 4.0)]


def test_nothing_landed_or_no_stock(spark, tmp_path):
    requests = asked(spark, ("ab", "11-01-2024", "11-20-2024"))
    out = str(tmp_path / "none")
    run_daily_job(spark, str(tmp_path / "landing"), requests, NOW, out)
    assert listed(spark.read.parquet(f"{out}/report_index"), ACCOUNT, "status") == [("AB", "NO_ORDERS")]
    land(spark, tmp_path / "landing")
    out = str(tmp_path / "orders-only")
    folders = {ORDERS_REPORT: f"{tmp_path}/landing/{ORDERS_REPORT}", INVENTORY_REPORT: f"{tmp_path}/nowhere"}
    run_daily_job(spark, folders, requests, NOW, out)
    assert {r[0] for r in listed(spark.read.parquet(f"{out}/summary").filter("NOT is_total"), "remaining units")} == {0.0}


def test_scratch_tables_are_removed(spark, tmp_path):
    scratch = Scratch(spark)
    assert scratch.folder.startswith(shared_folder(spark))
    table = scratch.table(spark.range(3), "numbers")
    assert table.count() == 3
    scratch.clear()
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch.folder)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_only_written_partitions_are_replaced(spark, tmp_path):
    out = str(tmp_path / "t")
    df = spark.createDataFrame([("ab", 1), ("cd", 1)], f"{ACCOUNT} string, n int")
    for fmt in ("parquet", "json", "csv"):
        path = f"{out}/{fmt}"
        write_partitions(df, path, fmt=fmt)
        write_partitions(df.filter(F.col(ACCOUNT) == "cd").withColumn("n", F.lit(2)), path, fmt=fmt, order="n")
        read = spark.read.option("header", True).format(fmt).load(path)
        assert sorted((a, int(n)) for a, n in listed(read, ACCOUNT, "n")) == [("ab", 1), ("cd", 2)]


def test_report_files_are_in_order(spark, tmp_path):
    df = spark.range(100).select(F.lit("ab").alias(ACCOUNT), (100 - F.col("id")).alias("report_rank")).repartition(3)
    write_partitions(df, str(tmp_path / "t"), order="report_rank")
    ranks = [r[0] for r in spark.read.parquet(str(tmp_path / "t")).select("report_rank").collect()]
    assert ranks == list(range(1, 101))


def test_a_large_partition_is_written_by_several_tasks(many_blocks, tmp_path):
    df = many_blocks.range(4000).select(F.lit("hot").alias(ACCOUNT), F.col("id").alias("report_rank"))
    write_partitions(df, str(tmp_path / "t"), order="report_rank")
    assert len(list((tmp_path / "t" / f"{ACCOUNT}=hot").glob("*.parquet"))) == 4
