"""Joins with keys of very many rows, against the engine's own join."""

import random

import pytest
from pyspark.sql import functions as F

from tallyshelf.operators import hot_joins as H
from tallyshelf.plans.on_hand import on_hand_report
from tallyshelf.plans.sales_report import sales_report
from tallyshelf.scratch import Scratch
from tests.tables import orders, ranked, stock


def sides(spark, seed=5):
    """Keys that are hot left, right, both and nowhere, on one side only, and null."""
    rng = random.Random(seed)
    left = [("a", "x", i) for i in range(300)] + [("a", "y", i) for i in range(3)] + [("b", "x", i) for i in range(200)] + [("c", "z", 1), ("c", None, 2), (None, None, 3)]
    left += [("only", "left", i) for i in range(150)] + [("few", "left", 0)] + [(rng.choice("pq"), rng.choice("uv"), i) for i in range(20)]
    right = [("a", "x", -i) for i in range(7)] + [("a", "y", -i) for i in range(250)] + [("b", "x", -i) for i in range(220)] + [("c", None, -5), (None, None, -6), ("c", "z", -7)]
    right += [("only", "right", -i) for i in range(150)] + [(rng.choice("pq"), rng.choice("uw"), -i) for i in range(20)]
    rng.shuffle(left)
    return spark.createDataFrame(left, "k string, l string, n long"), spark.createDataFrame(right, "k string, l string, m long")


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("keys", [["k", "l"], ["k"]])
def test_rows_are_those_of_a_plain_join(spark, monkeypatch, how, keys):
    monkeypatch.setattr(H, "HOT_ROWS", 20)
    left, right = sides(spark)
    if keys == ["k"]:
        left, right = left.drop("l"), right.drop("l")
    want, got = left.join(right, keys, how), H.spread_join(left, right, keys, Scratch(spark), how)
    assert got.columns == want.columns and rows(got) == rows(want)
    once = right.dropDuplicates(keys)
    assert rows(H.spread_join(left, once, keys, Scratch(spark), how, unique=True)) == rows(left.join(once, keys, how))
    for one, other in ((left.limit(0), right), (left, right.limit(0))):
        assert rows(H.spread_join(one, other, keys, Scratch(spark), how)) == rows(one.join(other, keys, how))


def test_hot_keys_are_few_and_null_is_none(spark, monkeypatch):
    monkeypatch.setattr(H, "HOT_ROWS", 20)
    left, _ = sides(spark)
    most = H.part_size(left.count(), 4)
    found = {(r.k, r.l): r.parts for r in H.hot_keys(left, ["k", "l"], "parts").collect()}
    assert found == {("a", "x"): -(-300 // most), ("b", "x"): -(-200 // most), ("only", "left"): -(-150 // most)}
    many = left.select(F.lit(None).cast("string").alias("k"), "n").crossJoin(spark.range(2))
    assert H.hot_keys(many, ["k"], "parts").count() == 0
    assert H.hot_keys(left.limit(5), ["k"], "parts") is None
    assert H.part_size(10**12, 200) * H.HOT_KEYS >= 10**12
    with pytest.raises(ValueError):
        H.spread_join(left, left, ["k"], Scratch(spark), "full")


def test_no_task_holds_a_hot_key(many_blocks, monkeypatch):
    """10^6 distinct rows of one key beside others: no shuffle partition above 3 x the median."""
    spark = many_blocks
    monkeypatch.setattr(H, "HOT_ROWS", 10_000)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        scratch = Scratch(spark)
        right = scratch.table(spark.range(1_000_000).selectExpr("'hot' AS sku", "id AS units").union(spark.range(20_000).selectExpr("concat('s', id)", "id")), "right")
        left = scratch.table(spark.range(2).selectExpr("'hot' AS sku", "id AS name").union(spark.range(20_000).selectExpr("concat('s', id)", "id")), "left")
        joined = H.spread_join(left, right, ["sku"], scratch)
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert sum(sizes) == 2_020_000 and len(sizes) == 16 and sizes[-1] <= 3 * sizes[8]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_reports_with_hot_skus_are_the_same(spark, monkeypatch):
    lines = orders(spark, *[("s1", f"p{i % 3}", "2", "1") for i in range(9)], ("s2", "p", "3", "2"), ("s3", "p", "4", "1"))
    listed = stock(spark, *[("s1", str(i)) for i in range(60)], ("s1", "x"), ("s1", "5"), ("s2", "7"), ("s4", "1"))
    plain = ranked(sales_report(lines, listed).summary), rows(on_hand_report(lines, listed))
    monkeypatch.setattr(H, "HOT_ROWS", 5)
    assert (ranked(sales_report(lines, listed).summary), rows(on_hand_report(lines, listed))) == plain
    assert len(plain[0]) == 3 * 62 + 3


def test_a_join_without_hot_keys_is_a_plain_one(spark, monkeypatch):
    """Tables above the limit of rows, whose keys are not: no key is counted on its own, and no row gets a cell."""
    monkeypatch.setattr(H, "HOT_ROWS", 20)
    left = spark.range(3000).selectExpr("concat('s', id % 1000) AS sku", "id AS n")
    right = spark.range(2000).selectExpr("concat('s', id % 900) AS sku", "id AS m")
    assert H.part_size(3000, 4) > 20 and H.hot_keys(left, ["sku"], "parts").isEmpty()
    joined = H.spread_join(left, right, ["sku"], Scratch(spark))
    assert H.LEFT_CELL not in joined._jdf.queryExecution().toString() and rows(joined) == rows(left.join(right, "sku", "left"))
