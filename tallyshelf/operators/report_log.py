"""The log of requested reports: which one is ready, and which one to use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshelf.columns import ACCOUNT, INVENTORY_REPORT, ORDERS_REPORT
from tallyshelf.errors import NoReadyReportError

# Processing states.
READY = "DONE"
FAILED = ("FATAL", "CANCELLED")

KEYS = (ACCOUNT, "report_type")


def latest_ready(log: DataFrame) -> DataFrame:
    """The ready report that ended last, per account and report type; equal times go to the smaller id.

    A minimum over (time, id) pairs: every map task sends on one row per key, however many reports that has.
    """
    ended = F.try_to_timestamp(F.col("processing_end_time").cast("string"))
    ready = log.filter(F.col("processing_status") == READY).withColumn("ended", ended).filter("ended IS NOT NULL")
    first = F.min(F.struct((-F.unix_micros("ended")).alias("newest"), "report_id", "ended"))
    return ready.groupBy(*KEYS).agg(first.alias("first")).select(
        *KEYS, F.col("first.report_id").alias("report_id"), F.col("first.ended").alias("processing_end_time")
    )


def resolve_reports(log: DataFrame) -> DataFrame:
    """The report to use for every request of the log.

    direct: it is ready. fallback: stock has no date range, so the latest ready one will do. failed: an order
    report, or no ready report to fall back to. pending: not finished.
    """
    latest = latest_ready(log).filter(F.col("report_type") == INVENTORY_REPORT).select(
        *KEYS, F.col("report_id").alias("latest_id")
    )
    status, latest_id = F.col("processing_status"), F.col("latest_id")
    fell = status.isin(*FAILED)
    return log.join(latest, list(KEYS), "left").withColumns({
        "resolution": F.when(status == READY, F.lit("direct"))
        .when(fell & latest_id.isNotNull(), F.lit("fallback"))
        .when(fell, F.lit("failed"))
        .otherwise(F.lit("pending")),
        "resolved_report_id": F.when(status == READY, F.col("report_id")).when(fell, latest_id),
    }).drop("latest_id")


def bindings(log: DataFrame, landed: DataFrame) -> DataFrame:
    """Every request with the report to use and whether that has landed: bound, missing, failed or pending.

    `landed` has an account_name and report_id for each report that files are there of.
    """
    there = landed.select(ACCOUNT, F.col("report_id").alias("resolved_report_id")).distinct().withColumn("there", F.lit(True))
    rows = resolve_reports(log).join(there, [ACCOUNT, "resolved_report_id"], "left")
    found = F.when(F.col("resolved_report_id").isNull(), F.col("resolution")).when(F.col("there"), F.lit("bound")).otherwise(F.lit("missing"))
    return rows.select(*KEYS, "report_id", "processing_status", "processing_end_time", "resolution", "resolved_report_id", found.alias("binding"))


def bound_reports(bound: DataFrame, report_type: str) -> DataFrame:
    """account_name and report_id of the reports to read. Of stock reports, the one that was ready last: a snapshot has no date range."""
    rows = bound.filter((F.col("report_type") == report_type) & (F.col("binding") == "bound"))
    if report_type == INVENTORY_REPORT:
        # A fallback's own time says nothing; the report that it falls back to has a row of its own.
        rows = latest_ready(rows.filter(F.col("report_id") == F.col("resolved_report_id")))
        return rows.select(ACCOUNT, "report_id")
    return rows.select(ACCOUNT, F.col("resolved_report_id").alias("report_id")).distinct()


def last_ready_report_id(log: DataFrame, account: str, report_type: str | None = None) -> str:
    """The id for one account and type; raises when there is none."""
    rows = latest_ready(
        log.filter((F.col(ACCOUNT) == account) & (F.col("report_type") == (report_type or ORDERS_REPORT)))
    ).head(1)
    if not rows:
        raise NoReadyReportError(f"no ready {report_type or ORDERS_REPORT} report for {account}")
    return rows[0]["report_id"]
