"""Written intermediate tables: the shared folder they go to, and their removal."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder `spark.checkpoint.dir` names. Only a session inside one process gets its own, until it ends."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tallyshelf-")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    sc.setCheckpointDir(folder)
    return folder


@contextmanager
def shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files behind. For jobs that write their steps as tables.

    Without this, they stay until the driver happens to collect its garbage. A lost executor is no matter: a query that
    still runs keeps its files.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Scratch:
    """Tables written once and read many times: they cut lineage and survive lost executors.

    Results built on them stay valid until `clear()`, which a job calls after writing its own outputs. Whatever is
    left goes when the driver ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/tallyshelf-{uuid.uuid4().hex}"
        self._path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._files = self._path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._files.mkdirs(self._path)
        self._files.deleteOnExit(self._path)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        with shuffle_files_removed(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        self._files.delete(self._path, True)
