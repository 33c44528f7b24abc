import struct

import xxhash

from tallyshelf.llm.sharding import shard_documents, with_shard, write_shards
from tests.llm.samples import odd_documents, rows_of


def plain_jump(key, shards):
    """The published loop."""
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def spark_hash(doc_id):
    return xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42)


def test_new_shards_take_rows_only_into_themselves(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "'t' AS text")
    rows = shard_documents(docs, 7).collect()
    moved = [r for r in rows if r.shard != r.grown_shard]
    assert all(r.grown_shard == 7 for r in moved) and 450 < len(moved) < 800
    counts = [sum(r.shard == s for r in rows) for s in range(7)]
    assert min(counts) > 550 and all((r.shard, r.grown_shard) == (plain_jump(spark_hash(r.doc_id), 7), plain_jump(spark_hash(r.doc_id), 8)) for r in rows[::50])


def test_odd_rows(spark, many_blocks):
    docs = odd_documents(spark)
    rows = shard_documents(docs, 3).collect()
    assert len(rows) == docs.count()
    for shard in range(3):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (5, 6)} == {(1, 0)}


def test_repeated_rows_have_slots_of_their_own(spark, many_blocks):
    docs = spark.range(3000).selectExpr("1L AS doc_id", "'t' AS text")
    assert sorted(r.slot for r in shard_documents(docs, 4).collect()) == list(range(3000))


def test_empty_and_one_shard(spark):
    docs = odd_documents(spark)
    assert shard_documents(docs.limit(0), 4).count() == 0
    assert {r.shard for r in shard_documents(docs, 1).collect()} == {0}


def test_written_shards_hold_all_documents(spark, tmp_path):
    docs = odd_documents(spark).drop("shard")
    write_shards(docs, str(tmp_path / "out"), 4, parts=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(back, "doc_id", "text", "shard") == rows_of(with_shard(docs, 4), "doc_id", "text", "shard")
