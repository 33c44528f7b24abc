"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from checks.queries import registered  # noqa: E402
from tallyshelf.session import session  # noqa: E402

HEADLINES = (
    "sales_report", "report_index", "raw_data", "sales_report_by_window", "sales_report_small_accounts",
    "sales_report_repeated_stock", "sales_by_sku", "sales_with_stock", "on_hand_report", "clean_orders", "quarantine",
    "dedup_chunks", "window_filter", "window_validate", "account_coverage", "latest_ready_report", "resolve_report",
    "report_log_json", "bars", "flat_file_scan",
)


def timed(run, spark, sf_dir: str) -> float:
    """Seconds to plan the query and compute every row and column of its result."""
    started = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = session("bench", **{
        "spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    timed(queries["sales_report"], spark, sf_dir)  # start-up of the engine, not counted
    seconds = {name: timed(queries[name], spark, sf_dir) for name in HEADLINES}
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
