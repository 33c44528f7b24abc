"""Names and first lines of landed files, listed by Spark and read in its tasks."""

from __future__ import annotations

from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Files whose first lines one task reads.
PER_TASK = 256


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Data files below `folder`, sorted; a single file is itself, and a missing folder has none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return []
    # Only names are asked for, so no content is read. Spark leaves out hidden files (_ and .).
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return sorted(row["path"] for row in found.select("path").toLocalIterator())


def file_table(spark: SparkSession, folder: str) -> DataFrame:
    """path, length and modificationTime of the data files below `folder`, as a table; no content is read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "path string, length long, modificationTime timestamp")
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length", "modificationTime")


def largest_file(spark: SparkSession, folder: str) -> int:
    """Bytes of the largest data file below `folder`, 0 without any."""
    return file_table(spark, folder).agg(F.max("length").alias("length")).head()["length"] or 0


def _store(path: str) -> tuple[str, str]:
    """The store's root as a URI, and the path inside, as it is: names may hold what a URI would decode."""
    if path.startswith("file:"):
        return "file:///", "/" + path.removeprefix("file:").lstrip("/")
    scheme, _, rest = path.partition("://")
    host, _, inside = rest.partition("/")
    return f"{scheme}://{host}/", f"/{inside}"


def _heads() -> Callable:
    """First lines of a batch of files, decompressed by suffix. All that it needs is inside: workers may lack this package."""
    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        stores = {}
        for batch in batches:
            lines = []
            for root, inside in zip(batch.column("root").to_pylist(), batch.column("inside").to_pylist()):
                if root not in stores:
                    stores[root] = fs.FileSystem.from_uri(root)
                files, base = stores[root]
                parts = []
                with files.open_input_stream(base.rstrip("/") + inside, compression="detect") as stream:
                    while (more := stream.read(1 << 14)):
                        parts.append(more)
                        if b"\n" in more:
                            break
                lines.append(b"".join(parts).split(b"\n", 1)[0].removesuffix(b"\r"))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(lines, pa.binary())], ["path", "line"])

    return run


def _driver_line(spark: SparkSession, file: str, encoding: str) -> str:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        data = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(data, encoding)).readLine() or ""
    finally:
        stream.close()


def first_lines(spark: SparkSession, files: list[str], encoding: str) -> dict[str, str]:
    """The first line of each file; empty for an empty file.

    Tasks open the files, a few hundred each. Only in a store that tasks have no client for, the driver does.
    """
    if not files:
        return {}
    try:
        fs.FileSystem.from_uri(_store(files[0])[0])
    except (OSError, ValueError):
        return {f: _driver_line(spark, f, encoding) for f in files}
    paths = spark.createDataFrame([(f, *_store(f)) for f in files], "path string, root string, inside string")
    paths = paths.repartition(-(-len(files) // PER_TASK), F.xxhash64("path"))
    heads = paths.mapInArrow(_heads(), "path string, line binary").toLocalIterator()
    return {r["path"]: bytes(r["line"]).decode(encoding) for r in heads}
