"""WARC archives: writing, normalising whole-file gzip streams, and reading back by index.

A crawl may come as archives that are one gzip stream from start to end, where no record can be reached but from the
front. The normaliser inflates such a file once, a chunk at a time, writes every record as a gzip member of its own, and
writes an index of the members' offsets beside it (one JSON object per line) and as a table.

Records with equal payloads of at least REVISIT_BYTES are stored once, as the response of the smallest page id; the others are
revisits that refer to it.

Scale: a file is the unit of work, and files are rolled at ROLL bytes. Inflating and writing hold a chunk, not a record.
Files get names that no second attempt uses, and only files that a finished task reports are read on, so a lost executor
leaves an unused file at most. Files go through the file system of the folder (local, hdfs, s3).

Edge cases. A null payload is empty, a null URL is left out. Pages alike in id and payload all are responses, if that id is
the smallest. A null page id is never the smallest; of null ids only, all are responses. An empty table gives no
files and an empty index. Line breaks and blanks in URLs are percent-encoded. Extra columns are left out. A stream that
breaks off, or a payload that differs from its digest, is an error.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshelf.llm.common import ship_package, text_of
from tallyshelf.scratch import Scratch

# Documented parameters: payloads that are stored once, bytes of a chunk, uncompressed bytes of a file, level of gzip.
REVISIT_BYTES, CHUNK, ROLL, LEVEL = 100, 1 << 20, 256 << 20, 6
# Documented parameter: the date of all records, so that equal input makes equal archives.
DATE = "2000-01-01T00:00:00Z"
# Fixed values of the format.
VERSION, GZIP = b"WARC/1.1", 31
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"
INDEX = "archive string, offset long, length long, record_id string, record_type string, url string, digest string"


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", scratch: Scratch | None = None) -> DataFrame:
    """page_id, url, payload, digest, record_type, refers_to of every page.

    Only digests that occur twice are kept for the join, as a written table, so Spark knows its size.
    """
    scratch = scratch or Scratch(pages.sparkSession)
    payload = text_of(html).cast("binary")
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    stored_once = F.octet_length("payload") >= REVISIT_BYTES
    heads = rows.where(stored_once).groupBy("digest").agg(F.min("page_id").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    heads = scratch.table(heads.select(F.col("digest").alias("its_digest"), "head"), "heads")
    rows = rows.join(heads, (F.col("digest") == F.col("its_digest")) & stored_once, "left")
    revisit = F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head"))
    return rows.select(
        "page_id", "url", "payload", "digest", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("head")).alias("refers_to"),
    )


def record_id(key: object) -> str:
    return f"<{URN}{'' if key is None else quote(str(key), safe='')}>"


def key_of(identifier: str | None) -> str | None:
    """The page id in a record id, null if it was null."""
    return unquote(identifier.strip("<>")[len(URN) :]) or None if identifier else None


def record_of(key: object, url: str | None, payload: bytes, digest: str, kind: str, refers_to: object) -> bytes:
    """A whole record. A revisit keeps the HTTP head, whose length is that of the payload it leaves out."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(key)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url))
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    head = VERSION + b"\r\n" + "\r\n".join(lines).encode("utf-8", "replace")
    return head + b"\r\n\r\n" + block + b"\r\n\r\n"


def fields_of(head: bytes) -> dict[str, str]:
    """Header fields of a record or of an HTTP head, by lower-case name."""
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines if line)}


class Inflater:
    """Reads a gzip stream, or several one after the other, a chunk at a time."""

    def __init__(self, source):
        self.source, self.z, self.pending, self.buffer, self.ended = source, zlib.decompressobj(GZIP), b"", bytearray(), False

    def more(self) -> bool:
        """Adds to the buffer; false at the end of the file."""
        if self.z.eof:
            self.pending = self.z.unused_data
            self.z = zlib.decompressobj(GZIP)
        if not self.pending:
            self.pending = self.source.read(CHUNK)
            if not self.pending:
                self.ended = True
                return False
        self.buffer += self.z.decompress(self.pending, CHUNK)
        self.pending = b"" if self.z.eof else self.z.unconsumed_tail
        return True

    def head(self) -> bytes | None:
        """The next record's header, null at the end of the file."""
        while (end := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self.more():
                if self.buffer.strip():
                    raise EOFError("the archive ends inside a record's header")
                return None
        head = bytes(self.buffer[:end])
        del self.buffer[: end + 4]
        return head

    def take(self, n: int) -> Iterator[bytes]:
        """The next n bytes, in chunks."""
        while n:
            if not self.buffer and not self.more():
                raise EOFError("the archive ends inside a record")
            part = bytes(self.buffer[:n])
            del self.buffer[: len(part)]
            n -= len(part)
            if part:
                yield part


def _member(out, parts: Iterable[bytes], level: int) -> None:
    z = zlib.compressobj(level, zlib.DEFLATED, GZIP)
    for part in parts:
        out.write(z.compress(part))
    out.write(z.flush())


def qualified(scratch: Scratch, folder: str) -> str:
    """The folder with its scheme, as the tasks' file systems want it; made if it isn't there."""
    path = scratch.spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(scratch.spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    whole = files.makeQualified(path).toString()
    return re.sub(r"^file:/(?!/)", "file:///", whole)


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _write_streams(folder: str, roll: int, level: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _open(folder)
        out = name = z = None
        records = size = 0
        done: list[tuple[str, int, int]] = []

        def close() -> None:
            out.write(z.flush())
            out.close()
            done.append((name, records, size))

        for batch in batches:
            for row in batch.to_pylist():
                record = record_of(row["page_id"], row["url"], row["payload"], row["digest"], row["record_type"], row["refers_to"])
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out, z = files.open_output_stream(f"{root}/{name}", compression=None), zlib.compressobj(level, zlib.DEFLATED, GZIP)
                out.write(z.compress(record))
                records, size = records + 1, size + len(record)
                if size >= roll:
                    close()
                    out = None
        if out is not None:
            close()
        columns = list(zip(*done, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], ["file", "n_records", "n_bytes"])

    return run


def write_streams(records: DataFrame, folder: str, roll: int = ROLL, level: int = LEVEL) -> DataFrame:
    """Writes archives that are one gzip stream each; one row per file. Run it once: every run writes files anew."""
    ship_package(records.sparkSession)
    return records.mapInArrow(_write_streams(folder, roll, level), "file string, n_records long, n_bytes long")


def _normalise(source: str, target: str, level: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _open(source)
        files_out, root_out = _open(target)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                archive = f"{uuid.uuid4().hex}.warc.gz"
                rows: list[tuple] = []
                with (
                    files.open_input_stream(f"{root}/{name}", compression=None) as raw,
                    files_out.open_output_stream(f"{root_out}/{archive}", compression=None) as out,
                    files_out.open_output_stream(f"{root_out}/{archive}.idx.jsonl", compression=None) as sidecar,
                ):
                    stream = Inflater(raw)
                    while (head := stream.head()) is not None:
                        fields = fields_of(head.lstrip())
                        offset = out.tell()

                        def parts(head=head, length=int(fields["content-length"])) -> Iterator[bytes]:
                            yield head.lstrip() + b"\r\n\r\n"
                            yield from stream.take(length)
                            yield b"\r\n\r\n"

                        _member(out, parts(), level)
                        for _ in stream.take(4):
                            pass
                        row = (
                            archive, offset, out.tell() - offset, fields["warc-record-id"], fields["warc-type"],
                            fields.get("warc-target-uri"), fields.get("warc-payload-digest"),
                        )
                        sidecar.write(json.dumps(dict(zip(("offset", "length", "record_id", "record_type", "url", "digest"), row[1:], strict=True))).encode() + b"\n")
                        rows.append(row)
                        if len(rows) == 10_000:
                            yield _index_batch(rows)
                            rows = []
                # Nothing is reported before the files are closed but whole batches, which a failed task takes back.
                yield _index_batch(rows)

    return run


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    names = [c.split()[0] for c in INDEX.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def normalise(manifest: DataFrame, source: str, target: str, level: int = LEVEL) -> DataFrame:
    """Rewrites each file of the manifest with a member per record and a sidecar; gives the index. Run it once."""
    ship_package(manifest.sparkSession)
    # A task per few files: the manifest is a small table, its files are not.
    spread = manifest.select("file").repartition(max(1, manifest.count()), "file")
    return spread.mapInArrow(_normalise(source, target, level), INDEX)


def _read(folder: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _open(folder)
        name, archive = None, None
        for batch in batches:
            found: list[tuple] = []
            for row in batch.select(["archive", "offset", "length"]).to_pylist():
                if row["archive"] != name:
                    if archive is not None:
                        archive.close()
                    name = row["archive"]
                    archive = files.open_input_file(f"{root}/{name}")
                archive.seek(row["offset"])
                record = zlib.decompress(archive.read(row["length"]), GZIP)
                head, _, rest = record.partition(b"\r\n\r\n")
                fields = fields_of(head)
                block = rest[: int(fields["content-length"])]
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = fields["warc-payload-digest"].removeprefix("sha256:")
                if fields["warc-type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"record {fields['warc-record-id']} of {name} differs from its digest")
                size = int(fields_of(http)["content-length"])
                found.append((key_of(fields["warc-record-id"]), fields.get("warc-target-uri"), size, digest, fields["warc-type"], key_of(fields.get("warc-refers-to")), payload))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
            columns = list(zip(*found, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["page_key", "url", "payload_bytes", "payload_digest", "record_type", "refers_to_key", "payload"],
            )
        if archive is not None:
            archive.close()

    return run


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """The records at the index's offsets: keys as text, payload (empty for revisits), sizes and digests of the full payload."""
    ship_package(index.sparkSession)
    rows = index.select("archive", "offset", "length").repartition("archive").sortWithinPartitions("archive", "offset")
    schema = "page_key string, url string, payload_bytes long, payload_digest string, record_type string, refers_to_key string, payload binary"
    return rows.mapInArrow(_read(folder), schema)


def archive_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", folder: str | None = None) -> tuple[DataFrame, str]:
    """Writes pages as whole-file streams, normalises these, and gives the index and the folder of the archives."""
    spark = pages.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    scratch = Scratch(spark)
    source, target = qualified(scratch, scratch.path("streams")), qualified(scratch, folder or scratch.path("archives"))
    manifest = scratch.table(write_streams(plan_records(pages, page_id, url, html, scratch), source), "manifest")
    return scratch.table(normalise(manifest, source, target), "index"), target
