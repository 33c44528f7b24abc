"""Runs registered queries and their SQL side by side: python -m checks.compare <sf_dir> [query ...]"""

from __future__ import annotations

import hashlib
import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from checks import oracle, queries
from tallyshelf.session import session

TABLES = tuple("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split())


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v) -> str:
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return repr(float(v))
    return str(v)


def rows_of(pdf: pd.DataFrame) -> list[tuple[str, ...]]:
    pdf = pdf[sorted(pdf.columns)].astype(object)
    return sorted(tuple(_cell(v) for v in row) for row in pdf.itertuples(index=False, name=None))


def digest(rows: list[tuple[str, ...]]) -> str:
    return hashlib.md5(repr(rows).encode()).hexdigest()


def main(sf_dir: str, names: list[str]) -> int:
    spark = session("compare", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), oracle.statements(), 0
    for name, run in queries.registered().items():
        if names and name not in names:
            continue
        started = time.time()
        got = run(spark, sf_dir).toPandas()
        took = time.time() - started
        if name not in sql:
            print(f"{name:32} rows={len(got)} no SQL {took:.1f}s", flush=True)
            continue
        want = con.execute(sql[name]).df()
        left, right = rows_of(got), rows_of(want)
        same = sorted(got.columns) == sorted(want.columns) and left == right
        print(f"{name:32} {'ok ' if same else 'BAD'} rows={len(left)}/{len(right)} {took:.1f}s", flush=True)
        if not same:
            bad += 1
            print("   columns", sorted(got.columns), sorted(want.columns))
            a, b = set(left) - set(right), set(right) - set(left)
            print("   spark only", sorted(a)[:3], "\n   sql only  ", sorted(b)[:3])
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else str(Path("/root/testdata/sf0.01")), sys.argv[2:]))
