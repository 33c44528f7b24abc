"""A training corpus from raw documents, stage by stage. Each stage works on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents; the last adds `shard`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyshelf.llm.decontaminate import drop_leaks
from tallyshelf.llm.language import known_language
from tallyshelf.llm.mixing import mixed_copies
from tallyshelf.llm.near_duplicates import keep_one
from tallyshelf.llm.sharding import with_shard
from tallyshelf.scratch import Scratch

# Documented parameters: least score of a language that counts as known, its least support, and the number of shards. Short
# clean texts score low, so the support decides, which doesn't depend on length.
LEAST_SCORE, LEAST_SUPPORT, SHARDS = 0.0, 0.5, 16


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a learned language: no letter in the text, junk, or a language or script never learned."""
    return known_language(docs, LEAST_SCORE, support=LEAST_SUPPORT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and samples documents so that the sources have their target shares."""
    return mixed_copies(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the shard that a document's id and the number of shards decide."""
    return with_shard(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# The language stage is a trained model, which SQL can't express; tests/llm hold every stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs
