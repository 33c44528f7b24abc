import json

import pytest

from tallyshelf import NoReadyReportError
from tallyshelf.columns import INVENTORY_REPORT, ORDERS_REPORT
from tallyshelf.operators.report_log import last_ready_report_id, latest_ready, resolve_reports
from tallyshelf.sources.log_payloads import parse_log, scan_log
from tests.tables import listed

SCHEMA = "account_name string, report_id string, report_type string, processing_status string, processing_end_time string"


def log(spark, *rows):
    return spark.createDataFrame([("ab", *r) for r in rows], SCHEMA)


def test_latest_ready(spark):
    got = latest_ready(log(
        spark, ("1", ORDERS_REPORT, "DONE", "2024-11-01T00:00:00Z"), ("2", ORDERS_REPORT, "DONE", "2024-11-02T00:00:00Z"),
        ("3", ORDERS_REPORT, "FATAL", "2024-11-03T00:00:00Z"), ("4", ORDERS_REPORT, "DONE", "soon"),
        ("9", INVENTORY_REPORT, "DONE", "2024-11-01T00:00:00Z"), ("8", INVENTORY_REPORT, "DONE", "2024-11-01T01:00:00+01:00"),
    ))
    assert sorted(listed(got, "report_type", "report_id")) == sorted([(ORDERS_REPORT, "2"), (INVENTORY_REPORT, "8")])


def test_last_ready_report_id(spark):
    table = log(spark, ("1", ORDERS_REPORT, "DONE", "2024-11-01T00:00:00Z"), ("2", INVENTORY_REPORT, "FATAL", None))
    assert last_ready_report_id(table, "ab") == "1"
    for account, kind in (("ab", INVENTORY_REPORT), ("cd", ORDERS_REPORT)):
        with pytest.raises(NoReadyReportError):
            last_ready_report_id(table, account, kind)


def test_resolution(spark):
    table = log(
        spark, ("1", ORDERS_REPORT, "DONE", "2024-11-01T00:00:00Z"), ("2", ORDERS_REPORT, "FATAL", None),
        ("3", INVENTORY_REPORT, "CANCELLED", None), ("4", INVENTORY_REPORT, "DONE", "2024-11-01T00:00:00Z"),
        ("5", INVENTORY_REPORT, "IN_QUEUE", None), ("6", INVENTORY_REPORT, "N/A", None),
    )
    assert sorted(listed(resolve_reports(table), "report_id", "resolution", "resolved_report_id")) == [
        ("1", "direct", "1"), ("2", "failed", None), ("3", "fallback", "4"), ("4", "direct", "4"),
        ("5", "pending", None), ("6", "pending", None),
    ]


def test_nothing_to_fall_back_to(spark):
    table = log(spark, ("3", INVENTORY_REPORT, "FATAL", None), ("4", ORDERS_REPORT, "DONE", "2024-11-01T00:00:00Z"))
    assert ("3", "failed", None) in listed(resolve_reports(table), "report_id", "resolution", "resolved_report_id")


def test_payloads(spark, tmp_path):
    pages = [
        {"reports": [{"reportId": "1", "reportType": INVENTORY_REPORT, "processingStatus": "DONE",
                      "processingEndTime": "2024-11-01T00:00:00Z", "other": 1}, {"reportId": "2"}], "nextToken": "t"},
        {"reports": []}, {"errors": "none"},
    ]
    table = spark.createDataFrame([("ab", json.dumps(p, indent=4)) for p in pages] + [("ab", "no json")],
                                  "account_name string, value string")
    want = [("ab", "1", INVENTORY_REPORT, "DONE", "2024-11-01T00:00:00Z"), ("ab", "2", ORDERS_REPORT, "N/A", None)]
    assert listed(parse_log(table), "*") == want
    for i, page in enumerate(pages):
        folder = tmp_path / "log" / "account_name=007"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{i}.json").write_text(json.dumps(page, indent=4))
    assert sorted(listed(scan_log(spark, str(tmp_path / "log")), "*")) == [("007", *w[1:]) for w in want]
