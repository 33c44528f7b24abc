"""The daily job on the reports that a request log resolves to."""

from pyspark.sql import functions as F

from tallyshelf import Scratch
from tallyshelf.columns import ACCOUNT, INVENTORY_REPORT, ORDERS_REPORT
from tallyshelf.operators.report_log import bindings, bound_reports
from tallyshelf.plans.daily_job import landed_reports, load_files, run_daily_job
from tallyshelf.sources.flat_files import write_flat_files
from tests.tables import listed, orders, stock

NOW, DAY = "2024-11-25T12:00:00", "2024-11-10T12:00:00Z"
LOG = f"{ACCOUNT} string, report_id string, report_type string, processing_status string, processing_end_time string"


def log(spark, *rows):
    return spark.createDataFrame(list(rows), LOG)


def land(spark, folder):
    lines = orders(spark, ("a", "pa", "5", "1", DAY, "ab"), ("a", "pa", "7", "1", DAY, "ab"), ("a", "pa", "5", "1", DAY, "cd"), ("b", "pb", "3", "1", DAY, "ef"))
    ids = F.when(F.col("item-price") == "7", "r 2").otherwise(F.concat(F.lit("r+1"), F.col(ACCOUNT)))
    write_flat_files(lines.withColumn("report_id", ids), f"{folder}/{ORDERS_REPORT}", (ACCOUNT, "report_id"))
    units = stock(spark, ("a", "1", "ab"), ("a", "9", "ab"), ("a", "4", "cd"))
    ids = F.concat(F.lit("s"), F.col("`afn-fulfillable-quantity`"))
    write_flat_files(units.withColumn("report_id", ids), f"{folder}/{INVENTORY_REPORT}", (ACCOUNT, "report_id"))
    return str(folder)


def test_requests_are_bound_failed_pending_or_missing(spark):
    landed = spark.createDataFrame([("ab", "1"), ("ab", "s1"), ("cd", "3")], f"{ACCOUNT} string, report_id string")
    rows = log(spark, ("ab", "1", ORDERS_REPORT, "DONE", DAY), ("ab", "2", ORDERS_REPORT, "FATAL", None), ("ab", "3", ORDERS_REPORT, "DONE", DAY), ("ab", "4", ORDERS_REPORT, "IN_QUEUE", None),
               ("ab", "s1", INVENTORY_REPORT, "DONE", DAY), ("ab", "s2", INVENTORY_REPORT, "CANCELLED", None), ("cd", "s3", INVENTORY_REPORT, "FATAL", None))
    found = bindings(rows, landed)
    assert sorted(listed(found, ACCOUNT, "report_id", "binding", "resolved_report_id"), key=repr) == [
        ("ab", "1", "bound", "1"), ("ab", "2", "failed", None), ("ab", "3", "missing", "3"), ("ab", "4", "pending", None),
        ("ab", "s1", "bound", "s1"), ("ab", "s2", "bound", "s1"), ("cd", "s3", "failed", None)]
    assert listed(bound_reports(found, ORDERS_REPORT), ACCOUNT, "report_id") == [("ab", "1")]
    assert listed(bound_reports(found, INVENTORY_REPORT), ACCOUNT, "report_id") == [("ab", "s1")]


def test_reports_are_told_from_folder_names(spark, tmp_path):
    folder = land(spark, tmp_path / "in")
    assert sorted(listed(landed_reports(spark, folder, ORDERS_REPORT), ACCOUNT, "report_id")) == [("AB", "r 2"), ("AB", "r+1ab"), ("CD", "r+1cd"), ("EF", "r+1ef")]
    assert listed(landed_reports(spark, str(tmp_path / "none"), ORDERS_REPORT), ACCOUNT) == []


def test_only_resolved_reports_are_reported(spark, tmp_path):
    folder, out = land(spark, tmp_path / "in"), str(tmp_path / "out")
    rows = log(spark, ("ab", "r+1ab", ORDERS_REPORT, "DONE", DAY), ("ab", "r 2", ORDERS_REPORT, "FATAL", DAY), ("Cd", "r+1cd", ORDERS_REPORT, "DONE", DAY), ("ef", "gone", ORDERS_REPORT, "DONE", DAY),
               ("ab", "s1", INVENTORY_REPORT, "DONE", "2024-11-20T00:00:00Z"), ("ab", "s9", INVENTORY_REPORT, "DONE", "2024-11-19T00:00:00Z"), ("ab", "s10", INVENTORY_REPORT, "FATAL", None), ("cd", "s4", INVENTORY_REPORT, "IN_QUEUE", None))
    asked = spark.createDataFrame([(a, "11-01-2024", "11-20-2024") for a in ("ab", "cd", "ef")], f"{ACCOUNT} string, start_date string, end_date string")
    run_daily_job(spark, folder, asked, NOW, out, log=rows)
    assert sorted(listed(spark.read.parquet(f"{out}/report_index"), ACCOUNT, "status", "revenue")) == [("AB", "OK", 5.0), ("CD", "OK", 5.0), ("EF", "NO_ORDERS", None)]
    summary = spark.read.parquet(f"{out}/summary").filter("NOT is_total")
    assert sorted(listed(summary, ACCOUNT, "`remaining units`")) == [("AB", 1.0), ("CD", 0.0)]
    assert ("EF", "missing") in listed(spark.read.parquet(f"{out}/report_bindings"), ACCOUNT, "binding")
    # Without a log all that has landed is used, both stock reports too, whose rows each repeat the sales row.
    run_daily_job(spark, folder, asked, NOW, str(tmp_path / "all"))
    assert ("AB", 24.0) in listed(spark.read.parquet(f"{tmp_path}/all/report_index"), ACCOUNT, "revenue")


def test_files_outside_report_folders_are_of_no_report(spark, tmp_path):
    write_flat_files(orders(spark, ("a", "pa", "5", "1", DAY, "ab")), f"{tmp_path}/{ORDERS_REPORT}", (ACCOUNT,))
    none = spark.createDataFrame([("AB", "r1")], f"{ACCOUNT} string, report_id string")
    assert load_files(spark, str(tmp_path), ORDERS_REPORT, Scratch(spark), none).lines.count() == 0
