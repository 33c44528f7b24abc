"""Session settings the reports rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings, safe to apply to a session that someone else made.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Many partitions at first, merged up to this size: a task's memory then stays the same as tables grow. Lines take 10 to 20 times the
    # room in a sort or a hash table that they take in a shuffle file.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # The same for what a task reads of files: sums and sorts of its lines then stay in memory, whatever a table's size.
    "spark.sql.files.maxPartitionBytes": "16m",
    # Sides of which each partition is small are joined by a hash table, without sorting both.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16m",
    "spark.sql.parquet.compression.codec": "zstd",
    # Such files hold more than their size says to whoever chooses what to broadcast.
    "spark.sql.sources.fileCompressionFactor": "2.0",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def session(app: str = "tallyshelf", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
