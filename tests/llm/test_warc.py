import gzip
import hashlib
import io
import json
import zlib
from pathlib import Path

import pytest

from tallyshelf.llm import warc as W
from tallyshelf.llm.warc import archive_pages, normalise, plan_records, qualified, read_archives, write_streams
from tallyshelf.scratch import Scratch
from tests.llm.samples import CLASHES, prose

PAGE = "page_id long, url string, html string"


def pages(spark):
    long = prose(400_000, 1)
    rows = [
        (3, "http://a/3", "x" * 100), (1, "http://a/1", "x" * 100), (2, None, "x" * 99), (4, "http://a/4", "x" * 99), (5, "u r\nl", None), (6, "", ""),
        (1, "http://b/1", "x" * 100), (None, "http://n", "x" * 100), (None, "http://n", "y" * 200), (7, "http://ü", "é漢" * 60), (8, "http://a/8", long),
        (9, "http://a/9", long), (10, "http://a", "\r\n\r\nWARC/1.1\r\n\r\n" * 20),
    ]
    df = spark.createDataFrame(rows, PAGE)
    return df.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASHES + ("digest", "payload")]), rows


def plain(rows):
    least = {}
    for i, _, html in rows:
        if i is not None:
            least[html or ""] = min(least.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        head = least.get(html or "") if len(payload) >= 100 else None
        revisit = head is not None and head != i
        out.append((None if i is None else str(i), len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", str(head) if revisit else None))
    return sorted(out, key=repr)


def read(index, folder):
    columns = ("page_key", "payload_bytes", "payload_digest", "record_type", "refers_to_key")
    return sorted((tuple(r) for r in read_archives(index, folder).select(*columns).collect()), key=repr)


def test_round_trip(spark):
    df, rows = pages(spark)
    index, folder = archive_pages(df)
    assert read(index, folder) == plain(rows)
    payloads = {r.page_key: bytes(r.payload) for r in read_archives(index, folder).where("record_type = 'response'").collect()}
    assert payloads["8"] == prose(400_000, 1).encode() and payloads["7"] == ("é漢" * 60).encode()


def test_files_are_streams_then_members_with_a_sidecar(spark):
    df, rows = pages(spark)
    scratch = Scratch(spark)
    source, target = qualified(scratch, scratch.path("in")), qualified(scratch, scratch.path("out"))
    manifest = scratch.table(write_streams(plan_records(df.repartition(2)), source, roll=1 << 20), "manifest")
    for row in manifest.collect():
        raw = Path(source.removeprefix("file://"), row.file).read_bytes()
        z = zlib.decompressobj(31)
        whole = z.decompress(raw)
        assert z.eof and not z.unused_data and len(whole) == row.n_bytes and whole.count(b"WARC-Record-ID") == row.n_records
    assert manifest.count() > 2
    index = scratch.table(normalise(manifest, source, target), "index")
    assert index.count() == len(rows)
    for archive in {r.archive for r in index.collect()}:
        raw = Path(target.removeprefix("file://"), archive).read_bytes()
        lines = [json.loads(x) for x in Path(target.removeprefix("file://"), archive + ".idx.jsonl").read_text().splitlines()]
        at = 0
        for line in lines:
            assert line["offset"] == at
            z = zlib.decompressobj(31)
            record = z.decompress(raw[at : at + line["length"]])
            assert z.eof and not z.unused_data and record.startswith(b"WARC/1.1\r\n") and line["record_id"].encode() in record
            at += line["length"]
        assert at == len(raw)


def test_broken_streams_are_errors():
    raw = gzip.compress(W.record_of(1, "u", b"p" * 500, "d", "response", None))
    stream = W.Inflater(io.BytesIO(raw[:-40]))
    stream.head()
    with pytest.raises((EOFError, zlib.error)):
        list(stream.take(10_000))


def test_inflater_reads_small_chunks_and_many_members(monkeypatch):
    records = [W.record_of(i, None, b"p" * (i * 37), "d", "response", None) for i in range(40)]
    monkeypatch.setattr(W, "CHUNK", 7)
    for raw in (gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))):
        stream, seen = W.Inflater(io.BytesIO(raw)), []
        while (head := stream.head()) is not None:
            body = b"".join(stream.take(int(W.fields_of(head)["content-length"]) + 4))
            seen.append(head + b"\r\n\r\n" + body)
        assert seen == records


def test_empty(spark):
    index, folder = archive_pages(spark.createDataFrame([], PAGE))
    assert index.count() == 0 and read_archives(index, folder).count() == 0


def test_keys_of_any_text():
    for key in ("1", "a/b <c>", "é\n"):
        assert W.key_of(W.record_id(key)) == key
    assert W.key_of(W.record_id(None)) is None
