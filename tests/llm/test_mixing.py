import hashlib
import re
from collections import defaultdict

import pytest

from tallyshelf.llm.mixing import mix, mixed_copies
from tests.llm.samples import odd_documents, prose, rows_of


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Shares by weight; whatever is above its cap is shared again among the others."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target = {}
    total, open_sources = share * sum(sizes.values()), set(order)
    while open_sources:
        w = sum(weight[s] for s in open_sources)
        over = {s for s in open_sources if total * weight[s] / w > most * sizes[s]}
        if not over:
            return target | {s: total * weight[s] / w for s in open_sources}
        for s in over:
            target[s] = most * sizes[s]
        total -= sum(target[s] for s in over)
        open_sources -= over
    return target


def plain_odds(sizes, open_size):
    """p of each size class: growing with the binary digits of the size, at the level found by halving."""
    digits = [len(f"{n:b}") for n in sizes]
    low, high = 0.0, 1.0
    for _ in range(200):
        level = (low + high) / 2
        if sum(n * min(1, level * b) for n, b in zip(sizes, digits, strict=True)) < open_size:
            low = level
        else:
            high = level
    return {b: min(1, high * b) for b in digits}


def plain_copies(docs, seed=0):
    """Copies of each document (doc, source, text), by ranking every source in Python."""
    rows = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), hashlib.md5((t or "").encode()).hexdigest()) for d, s, t in docs]
    sizes = defaultdict(int)
    for _, s, n, _ in rows:
        sizes[s] += n
    target, copies = plain_targets(sizes), {}
    for s, size in sizes.items():
        its = [(d, n, h) for d, source, n, h in rows if source == s]
        whole = int(target[s] / size) if size else 0
        left = target[s] - whole * size
        p = plain_odds([n for _, n, _ in its], left) if left else {}
        ranked = []
        for d, n, h in its:
            copies[d], odds = whole, p.get(len(f"{n:b}"), 0)
            if odds > 1 - 1e-12:
                copies[d] += 1
                left -= n
            elif odds:
                u = (int(hashlib.md5(f"{seed}:{d}:{n}:{h}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
                ranked.append(((u / (1 - u)) / (odds / (1 - odds)), d, n))
        through = 0
        for _, d, n in sorted(ranked):
            if 2 * through + n <= 2 * left:
                copies[d] += 1
            through += n
    return copies


def test_targets_and_copies(spark):
    rows = [(i, prose(5 + 7 * i % 40, i), f"s{i % 7}" if i % 11 else None) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix(docs).collect()
    sizes = defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
    want, copies = plain_targets(sizes), plain_copies([(d, s, t) for d, t, s in rows])
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert (r.copies, r.taken) == (copies[r.doc_id], copies[r.doc_id] * r.size)
    for s in sizes:
        off = sum(r.taken for r in got if r.source == s) - want[s]
        assert abs(off) <= max(r.size for r in got if r.source == s) / 2
    assert rows_of(mix(docs)) == rows_of(mix(docs.repartition(5)))


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = mix(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert all(r.target <= 2 * r.source_size for r in rows)
    copies = mixed_copies(docs)
    assert copies.columns == docs.columns and copies.count() == sum(r.copies for r in rows)


def test_empty(spark):
    docs = odd_documents(spark)
    assert mix(docs.limit(0)).count() == 0 and mixed_copies(docs.limit(0)).count() == 0
    assert [r.taken for r in mix(docs.where("doc_id IN (5, 6, 7)")).collect()] == [0, 0, 0]


def test_inclusion_follows_the_odds(spark):
    rows = [(i, "w " * (4 if i % 2 else 64), f"s{i % 3}") for i in range(30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix(docs, share=0.5).collect()
    for s in ("s0", "s1", "s2"):
        its = [r for r in got if r.source == s]
        ratio = its[0].target / its[0].source_size
        assert 0 < ratio < 2
        left = its[0].target - int(ratio) * its[0].source_size
        for digits, p in plain_odds([r.size for r in its], left).items():
            drawn = [r.copies - int(ratio) for r in its if len(f"{r.size:b}") == digits]
            assert sum(drawn) / len(drawn) == pytest.approx(p, abs=0.02)


def test_equal_rows_are_split_at_the_cut(spark):
    rows = [(None, "one two three four five", f"s{i % 3}") for i in range(3000)] + [(1, "a b", "s0"), (None, None, "s1"), (None, "", "s2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    got = mix(docs).collect()
    assert len(got) == len(rows)
    for s in ("s0", "s1", "s2"):
        its = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in its) - its[0].target) <= 2.5
        assert all(r.taken <= 2 * r.size for r in its)
    copies = mixed_copies(docs).groupBy("source").count().collect()
    want = {s: sum(r.copies for r in got if r.source == s) for s in ("s0", "s1", "s2")}
    assert {r["source"]: r["count"] for r in copies} == want
    assert rows_of(mix(docs)) == rows_of(mix(docs.repartition(3)))


def test_equal_rows_over_many_files(spark, tmp_path):
    docs = spark.range(0, 40_000, 1, 16).selectExpr("CAST(NULL AS LONG) AS doc_id", "repeat('w ', 1 + CAST(id % 2 AS INT)) AS text", "'s' AS source")
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    got = mix(docs, share=0.3)
    (row,) = got.selectExpr("sum(taken) AS taken", "max(target) AS target", "max(source_size) AS size").collect()
    assert row.target == pytest.approx(0.3 * row.size) and abs(row.taken - row.target) <= 1
