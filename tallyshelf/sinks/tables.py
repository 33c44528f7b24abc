"""Finished reports as partitioned tables that can be written again: <base>/summary, <base>/raw_data, <base>/on_hand.

Headers are those of the source files. A table without any row holds an empty file, so that it can be read.
"""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyshelf import columns as C
from tallyshelf.scratch import Scratch

FORMATS = ("parquet", "csv", "json")
# Fixed value: the folder name of a null partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"


def require_format(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")


def _hadoop_path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _listed(spark: SparkSession, path: str) -> DataFrame | None:
    """`path` of every data file and its partition values as text, listed by Spark without reading; None if there are none."""
    files, where = _hadoop_path(spark, path)
    if not files.exists(where):
        return None
    before = spark.conf.get(INFERENCE)
    spark.conf.set(INFERENCE, "false")
    try:
        found = spark.read.format("binaryFile").load(path)
        return found.drop("modificationTime", "length", "content")
    finally:
        spark.conf.set(INFERENCE, before)


def _in_scope(spark: SparkSession, path: str, by: Sequence[str], scope: DataFrame, scratch: Scratch) -> DataFrame | None:
    """One file of each partition that `scope` names and that is there before a write."""
    found = _listed(spark, path)
    if found is None or not set(by) <= set(found.columns):
        return None
    keys = [k for k in by if k in scope.columns]
    # Folder names don't tell an empty text from a null.
    asked = scope.select(*[F.nullif(F.col(k).cast("string"), F.lit("")).alias(f"asked {k}") for k in keys]).distinct()
    same = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(f"`asked {k}`")) for k in keys])
    return scratch.table(found.join(asked, same, "left_semi").groupBy(*[F.col(f"`{k}`") for k in by]).agg(F.min("path").alias("path")).select("path"), "before")


def _drop_stale(spark: SparkSession, path: str, before: DataFrame | None) -> None:
    """Removes the partitions of `before` that the write has left as they were: the new result has no rows for them."""
    if before is None:
        return
    for row in before.join(_listed(spark, path).select("path"), "path", "left_semi").toLocalIterator():
        files, where = _hadoop_path(spark, row["path"])
        files.delete(where.getParent(), True)


def _keep_schema(df: DataFrame, path: str, by: Sequence[str], fmt: str) -> None:
    """An empty file if the table has none."""
    spark = df.sparkSession
    found = _listed(spark, path)
    if found is not None and not found.isEmpty():
        return
    fields = [f for f in df.schema.fields if f.name not in by]
    empty = spark.createDataFrame([], T.StructType(fields))
    folder = "/".join([path, *[f"{k}={NULL_FOLDER}" for k in by]])
    empty.write.mode("overwrite").options(header=True).format(fmt).save(folder)


def write_partitions(
    df: DataFrame, path: str, by: Sequence[str] = (C.ACCOUNT,), fmt: str = "parquet", order: str | None = None,
    scope: DataFrame | None = None,
) -> None:
    """Replaces the partitions `df` has rows for, removes those that `scope` names and `df` has no rows for, and leaves
    the others alone.

    `scope` has some or all of the `by` columns. Each partition's rows go to few files, and a large partition is
    split over several tasks: by ranges of `order` for rows that are cheap to sample, such as ranked ones, which are then in
    order in the files; otherwise by size, which takes no second pass.
    """
    require_format(fmt)
    spark = df.sparkSession
    scratch = Scratch(spark)
    before = None if scope is None else _in_scope(spark, path, by, scope, scratch)
    plain = df
    if order:
        df = df.repartitionByRange(*by, order).sortWithinPartitions(*by, order)
    else:
        df = df.hint("rebalance", *by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.options(header=True)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", False)
    writer.partitionBy(*by).format(fmt).save(path)
    _drop_stale(spark, path, before)
    _keep_schema(plain, path, by, fmt)
    scratch.clear()


def write_summary(
    summary: DataFrame, base: str, by: Sequence[str] = (C.ACCOUNT,), fmt: str = "parquet", scope: DataFrame | None = None
) -> None:
    write_partitions(C.to_headers(summary, C.SUMMARY_HEADERS), f"{base}/summary", by, fmt, "report_rank", scope)


def write_raw_data(
    raw: DataFrame, base: str, by: Sequence[str] = (C.ACCOUNT,), fmt: str = "parquet", scope: DataFrame | None = None
) -> None:
    write_partitions(C.to_headers(raw, C.RAW_HEADERS), f"{base}/raw_data", by, fmt, scope=scope)


def write_on_hand(
    report: DataFrame, base: str, by: Sequence[str] = (C.ACCOUNT,), fmt: str = "parquet", scope: DataFrame | None = None
) -> None:
    write_partitions(C.to_headers(report, C.ON_HAND_HEADERS), f"{base}/on_hand", by, fmt, "report_rank", scope)


def write_run(df: DataFrame, path: str, as_of: str, scope: DataFrame) -> None:
    """What one run found about the accounts in `scope`, kept apart by its time and by account."""
    rows, asked = df.withColumn("as_of", F.lit(as_of)), scope.select(C.ACCOUNT).withColumn("as_of", F.lit(as_of))
    write_partitions(rows, path, ("as_of", C.ACCOUNT), scope=asked)
