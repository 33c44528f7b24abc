"""What the operators share: words, texts without nulls, and the package on the workers' path."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word is a run of code points other than the six ASCII white-space characters.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty if null."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def pieces(batch: pa.RecordBatch, column: str, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most so many rows and bytes of a text column; a longer text is a slice of its own.

    Spark bounds a batch by its bytes already; what Python makes of a text is many times larger.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    begin = held = 0
    for at, n in enumerate(sizes):
        if at > begin and (at - begin >= rows or held + n > size):
            yield batch.slice(begin, at - begin)
            begin, held = at, 0
        held += n
    if begin < len(sizes):
        yield batch.slice(begin)


def moved(df: DataFrame) -> DataFrame:
    """For a side of a join that grows with the documents: both sides are dealt out by key, however small this one looks.

    A broadcast passes through the driver, which holds the rows, their hash table and its blocks: many times the packed file whose size
    decides about it, so its memory would grow with the documents until the file is too large to be broadcast.
    """
    return df.hint("merge")


def ship_package(spark: SparkSession) -> None:
    """Puts this package on the path of the Python workers, once for a Spark context.

    A job started with --py-files has it there already; a notebook or a test hasn't.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tallyshelf_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    folder = os.path.realpath(tempfile.mkdtemp(prefix="tallyshelf-py-"))
    package = Path(folder, "src", "tallyshelf")
    shutil.copytree(root / "tallyshelf", package, ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(f"{folder}/tallyshelf-workers", "zip", f"{folder}/src"))
    # Executors that start later still ask the driver for the archive, so it stays until the driver ends.
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc._tallyshelf_shipped = True
