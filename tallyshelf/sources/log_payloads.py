"""Payloads of the report-request log: JSON objects with a `reports` array."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshelf.columns import ACCOUNT, ORDERS_REPORT

# Fields of one report in the payload, and the state of one that shows none.
PAYLOAD = (
    "struct<reports: array<struct<reportId: string, reportType: string, processingStatus: string, "
    "processingEndTime: string>>>"
)
NO_STATUS = "N/A"


def parse_log(payloads: DataFrame, body: str = "value", keep: Sequence[str] = (ACCOUNT,)) -> DataFrame:
    """One row per report of every payload, all pages. An unnamed type is the orders report."""
    reports = payloads.select(*keep, F.inline(F.from_json(body, PAYLOAD)["reports"]))
    return reports.select(
        *keep,
        F.col("reportId").alias("report_id"),
        F.coalesce("reportType", F.lit(ORDERS_REPORT)).alias("report_type"),
        F.coalesce("processingStatus", F.lit(NO_STATUS)).alias("processing_status"),
        F.col("processingEndTime").alias("processing_end_time"),
    )


def scan_log(spark: SparkSession, path: str) -> DataFrame:
    """Landed payload files, one payload per file, below account_name=... folders."""
    return parse_log(spark.read.schema(f"value string, {ACCOUNT} string").text(path, wholetext=True))
