import random

from tallyshelf.llm.graph import components
from tallyshelf.scratch import Scratch


def test_chains_stars_and_rings(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    ring = [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    links = chain + star + ring + [(300, 300), (5, 6), (6, 5)]
    rng.shuffle(links)
    links = [p if rng.random() < 0.5 else p[::-1] for p in links]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), Scratch(spark)).collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200 + i: 200 for i in range(9)}
    assert got == want


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).count() == 0
