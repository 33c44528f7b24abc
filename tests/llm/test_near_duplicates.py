import random
import re

import numpy as np
import pytest

from tallyshelf.llm import near_duplicates as N
from tallyshelf.llm.near_duplicates import keep_one, near_duplicates, sketch
from tallyshelf.llm.shingles import shingle_set
from tallyshelf.scratch import Scratch
from tests.llm.samples import odd_documents, prose, rows_of


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_components(docs):
    """Smallest id of each document's component, from all pairs."""
    sets = [(d, plain_set(t)) for d, t in docs]
    leader = {d: d for d, _ in docs}

    def top(d):
        while leader[d] != d:
            d = leader[d]
        return d

    for i, (a, one) in enumerate(sets):
        for b, two in sets[:i]:
            both = len(one & two)
            if both and 100 * both >= 75 * (len(one) + len(two) - both):
                x, y = sorted((top(a), top(b)))
                leader[y] = x
    return {d: top(d) for d in leader}


def family(n, edits, seed, words=120, first=0):
    """Near copies of one text."""
    rng, base = random.Random(seed), prose(words, seed).split()
    rows = []
    for i in range(n):
        copy = list(base)
        for at in rng.sample(range(words), rng.randint(0, edits)):
            copy[at] = f"x{rng.randrange(10**6)}"
        rows.append((first + i, " ".join(copy)))
    return rows


@pytest.mark.parametrize("hubs", [1, 2])
def test_families_of_near_copies(spark, hubs, monkeypatch):
    monkeypatch.setattr(N, "HUBS", hubs)
    monkeypatch.setattr(N, "BLOCK_CLASSES", 16)
    rows = family(60, 9, 1) + family(40, 5, 2, first=100) + [(200 + i, prose(80, 300 + i)) for i in range(30)]
    random.Random(3).shuffle(rows)
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = plain_components(rows)
    assert got == want and len(set(want.values())) > 35


def test_sketches_estimate_similarity():
    a, b = np.unique(np.random.default_rng(1).integers(0, 2**63, (2, 3000), dtype=np.uint64), axis=0)
    one, two = np.union1d(a[:2500], b[:500]), np.union1d(a[:2500], b[500:1000])
    estimate = (sketch(one) == sketch(two)).mean()
    true = len(np.intersect1d(one, two)) / len(np.union1d(one, two))
    assert abs(estimate - true) < 0.16
    assert (sketch(a[:1]) != N.EMPTY).all() and (sketch(a[:3]) != N.EMPTY).all()


def test_shingles_of_long_texts_do_not_depend_on_pieces(monkeypatch):
    text = prose(3000, 9) + " " + "w" * 500 + " " + prose(10, 8)
    whole = shingle_set(text)
    monkeypatch.setattr("tallyshelf.llm.shingles.PIECE", 400)
    assert (shingle_set(text) == whole).all() and len(whole) == len(plain_set(text))


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = near_duplicates(docs)
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in rows.collect()}
    assert rows.count() == docs.count()
    assert got[(1, 116)] == (1, True) and got[(2, 116)] == (1, False) and got[(3, 116)] == (1, False)
    assert got[(3, 86)] == (3, True) and got[(4, 86)] == (3, False)
    for empty in (5, 6, 7):
        assert got[(empty, 0)] == (empty, True)
    assert got[(9, 1)] == (9, True) and got[(11, 1)] == (11, True) and got[(12, 1)] == (12, True) and got[(None, 36)] == (None, True)
    one = keep_one(docs)
    assert one.columns == docs.columns
    assert [r[0] for r in rows_of(one, "doc_id")] == sorted([1, 3, 5, 6, 7, 8, None, None, 9, 10, 11, 12, 13], key=repr)


def test_empty(spark):
    docs = odd_documents(spark).limit(0)
    assert near_duplicates(docs).count() == 0 and keep_one(docs).count() == 0


def test_no_join_on_documents_passes_through_the_driver(spark, monkeypatch):
    plans, table = [], Scratch.table

    def planned(scratch, df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return table(scratch, df, name)

    monkeypatch.setattr(Scratch, "table", planned)
    rng = random.Random(9)
    base = [f"w{rng.randint(1, 500)}" for _ in range(60)]
    texts = [" ".join([*base[:-1], f"x{i}"]) for i in range(5)] + ["alone in the whole wide world"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = keep_one(docs)
    plans.append(kept._jdf.queryExecution().executedPlan().toString())
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 5]
    joins = [p for p in plans if "Join" in p]
    assert len(joins) > 8
    # Families of open buckets are few, and their sizes are counted, not guessed from packed files.
    assert not [p for p in joins if "Broadcast" in p and "family" not in p]
