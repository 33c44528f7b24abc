"""Shards by jump consistent hashing: a stable key and the shard count decide, without a table of ring points.

Appending shards moves only the rows that the new shards take; no row moves between old shards.

Edge cases. A null key is a key of its own, so all its rows share a shard. A null text counts as empty. Repeated rows
share a shard and have slots of their own. An empty table gives no rows. Other columns stay as they are, but the
columns added here replace columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.llm.common import ship_package, text_of
from tallyshelf.operators.ranking import block_starts, rank_rows, sort_into_blocks
from tallyshelf.scratch import Scratch

# Fixed value: the multiplier of the published generator.
MULTIPLIER = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key. Each round moves the keys that still jump forward; about log(shards) rounds."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    at = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(at):
            state[at] = state[at] * MULTIPLIER + np.uint64(1)
            ahead = (shard[at] + 1) * (2.0**31 / ((state[at] >> np.uint64(33)).astype(np.float64) + 1))
            stays = ahead < shards
            at = at[stays]
            shard[at] = ahead[stays].astype(np.int64)
    return shard.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Shard number of a key of any type, from 0 to shards - 1."""
    if shards < 1:
        raise ValueError(f"at least one shard is needed, not {shards}")

    @F.pandas_udf("int")
    def number(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump(hashed.to_numpy().view(np.uint64), shards))

    return number(F.xxhash64(key))


def assign_shards(docs: DataFrame, key: str, shards: int, text: str = "text") -> DataFrame:
    """One narrow row per document: key, size, text_crc32, law, shard, and the shard once there is one more."""
    ship_package(docs.sparkSession)
    body = text_of(text)
    return docs.select(
        F.col(f"`{key}`"), (F.octet_length(body) + 1).cast("bigint").alias("size"), F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"), shard_of(F.col(f"`{key}`"), shards).alias("shard"),
        shard_of(F.col(f"`{key}`"), shards + 1).alias("grown_shard"),
    )


def with_shard(docs: DataFrame, shards: int = 16, key: str = "doc_id") -> DataFrame:
    """The documents with their shard number, all columns, in one pass without a shuffle."""
    ship_package(docs.sparkSession)
    return docs.withColumn("shard", shard_of(F.col(f"`{key}`"), shards))


def number_slots(rows: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """Adds `slot`, gapless from 0 in each shard, in the order of the key's hash.

    The rows are range-sorted over all shards and numbered from the sizes of the sorted blocks, so a shard is never one
    task's work. `tie` splits a key that holds many rows.
    """
    rows = scratch.table(rows.withColumn("tie", F.monotonically_increasing_id()), "unsorted")
    order = [F.xxhash64(F.lit("slot"), F.col(f"`{key}`")), F.col(f"`{key}`"), F.col("tie")]
    rows = sort_into_blocks(rows, ["shard"], order, scratch)
    starts = scratch.table(block_starts(rows, ["shard"]), "starts")
    return rank_rows(rows, starts, ["shard"], first=0).withColumnRenamed("report_rank", "slot").drop("tie")


def shard_documents(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The assignment of every document, with slots."""
    scratch = Scratch(docs.sparkSession)
    return number_slots(assign_shards(docs, key, shards, text), key, scratch)


def write_shards(docs: DataFrame, path: str, shards: int = 16, key: str = "doc_id", parts: int = 8) -> None:
    """Writes whole documents to one folder per shard, each in `parts` files that split it by the key's hash."""
    part = F.pmod(F.xxhash64(F.lit("part"), F.col(f"`{key}`")), F.lit(parts))
    rows = with_shard(docs, shards, key).repartition(shards * parts, F.col("shard"), part)
    rows.write.mode("overwrite").partitionBy("shard").parquet(path)
