"""Stored files by suffix, and tables of JSON records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyshelf.sources.files import largest_file
from tallyshelf.sources.flat_files import scan_flat_files

# Suffixes that can be read, with the separator of the delimited ones.
SEPARATORS = {"csv": ",", "tsv": "\t"}
# Fixed value: what no JSON text holds in UTF-8, UTF-16 or UTF-32, so that a file is one line.
NO_JSON = "\0" * 7
# Documented parameter: files of arrays up to this many bytes are read as one line.
WHOLE_BYTES = 1 << 28
# The folders that arrays are written to.
ARRAY_FOLDERS = ("part", "chunk")


def scan_stored(spark: SparkSession, path: str, suffix: str | None = None) -> DataFrame:
    """A csv or tsv table as text columns, or the lines of a txt file as `value`.

    `suffix` is needed for a folder, whose own name does not tell.
    """
    suffix = suffix or path.removesuffix(".gz").rsplit(".", 1)[-1]
    if suffix in SEPARATORS:
        return scan_flat_files(spark, path, sep=SEPARATORS[suffix], encoding="UTF-8").rows
    if suffix == "txt":
        return spark.read.text(path)
    raise TypeError(f"only csv, tsv and txt files can be read, not {suffix!r}")


def scan_records(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, lines: bool = False
) -> DataFrame:
    """Files that each hold an array of row objects, or with `lines` one object per line. Values come as text.

    Name the `columns` to avoid the extra pass that looks for them. Use `lines` for large files: an array is read by
    one task, so a large table is to be written as many arrays, as `write_arrays` does.
    """
    reader = spark.read.option("primitivesAsString", True)
    if not lines:
        # As a stream, the reader goes back to the file for each number, to find how it was written; as one line, it looks into the bytes.
        whole = largest_file(spark, path) <= WHOLE_BYTES
        reader = reader.option("lineSep", NO_JSON) if whole else reader.option("multiLine", True)
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.json(path)


def records_from_text(df: DataFrame, body: str, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows out of a text column that holds an array of row objects."""
    fields = ", ".join(f"`{c}`: string" for c in columns)
    return df.select(*keep, F.inline(F.from_json(body, f"array<struct<{fields}>>")))


def write_records(df: DataFrame, path: str) -> None:
    """One JSON object per line, null keys kept, so that every row shows every column."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_arrays(df: DataFrame, path: str, by: Sequence[str], rows: int) -> None:
    """Files that each hold one array of at most `rows` row objects that agree in `by`.

    Rows are numbered inside their task, so neither a task nor a file holds a whole group, whatever its size.
    """
    cells = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    numbered = df.withColumn("chunk", F.expr(f"monotonically_increasing_id() div {rows}"))
    arrays = numbered.groupBy(*by, "chunk").agg(F.to_json(F.collect_list(cells)).alias("value"))
    folder = F.concat_ws("/", *[F.col(f"`{c}`") for c in by]).alias(ARRAY_FOLDERS[0])
    arrays.select("value", folder, "chunk").write.partitionBy(*ARRAY_FOLDERS).text(path)
