import hashlib
import random
import zlib

import pytest

from tallyshelf.llm import prefix_trie as P
from tallyshelf.llm.radix_tree import Few, Indexed, Tree, Whole, shared
from tallyshelf.llm.registry import regrafted

SCHEMA = "conv_id long, turn long, role string, text string"


def words(text):
    return len([w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w])


def plain_turns(rows):
    by = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            by.setdefault(conv, []).append((turn, role or "", text or ""))
    order = lambda t: (t[0] is not None, t[0] or 0, hashlib.md5(f"{len(t[1])}:{t[1]}{t[2]}".encode()).hexdigest())
    return {c: tuple(t[1:] for t in sorted(turns, key=order)) for c, turns in by.items()}


def plain_grafts(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        out[c] = convs.get(base, ())[:h] + turns[h:]
    return out


def plain_nodes(convs):
    """By every prefix of every conversation."""
    members, ends = {}, {}
    for c, turns in convs.items():
        ends.setdefault(turns, []).append(c)
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {p: 0 for p in members}
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(own) - 1) * words(p[-1][1]) if p else 0
    hashed = {p: hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest() for p in members}
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashed[p]) for p, m in members.items()), key=repr)


def nodes_of(spark, rows, graft=True):
    paths = P.paths_of(spark.createDataFrame(rows, SCHEMA))
    return sorted((tuple(r) for r in P.trie_nodes(regrafted(paths) if graft else paths).collect()), key=repr)


def talk(rng, convs, turns=8, texts=6):
    said = ["", "a", "b c", " d  e\tf ", "漢 字", "x" * 9000][:texts]
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(said)) for c in convs for t in range(rng.randint(1, turns))]


def test_layouts_grow():
    rng = random.Random(1)
    for many, kind in ((1, Few), (4, Few), (5, Few), (16, Few), (17, Indexed), (48, Indexed), (49, Whole), (256, Whole)):
        tree = Tree()
        order = rng.sample(range(256), many)
        for b in order:
            tree.add(b"ab" + bytes([b]) + b"tail").value = b
        layout = tree.root.layout
        if many > 1:
            assert isinstance(layout, kind) and tree.root.run == b"ab" and (kind is not Few or layout.most == (4 if many <= 4 else 16))
            assert [b for b, _ in layout.items()] == (sorted(order))
            assert all(layout.get(b).value == b for b in order) and (many == 256 or layout.get(next(b for b in range(256) if b not in order)) is None)


def test_trees_hold_every_key():
    rng = random.Random(2)
    keys = {bytes(rng.choice(b"xyz") for _ in range(rng.randint(0, 12))) for _ in range(3000)}
    tree = Tree()
    for key in rng.sample(sorted(keys), len(keys)):
        assert tree.add(key).value is None
        tree.add(key).value = key

    def walk(node, path):
        path += node.run
        if node.value is not None:
            yield path, node.value
        assert node.value is not None or node is tree.root or len(list(node.items())) > 1
        for b, kid in node.items():
            yield from walk(kid, path + bytes([b]))

    found = list(walk(tree.root, b""))
    assert [k for k, _ in found] == sorted(keys) and all(k == v for k, v in found)
    assert shared(b"abcd", b"xxabzd", 2) == 2 and shared(b"", b"x", 0) == 0 and shared(b"abc", b"ab", 0) == 2


def test_nodes_are_those_of_all_prefixes(spark):
    rng = random.Random(3)
    rows = talk(rng, range(-25, 230))
    rows += [(500 + i, t, "user", f"same {t}") for i in range(40) for t in range(5)]
    assert nodes_of(spark, rows) == plain_nodes(plain_grafts(plain_turns(rows)))


@pytest.mark.parametrize("turns, last, block", [(1, 1, 1), (2, 3, 2), (7, 5, 3), (40, 8, 7), (300, 10_000, 4)])
def test_chunks_levels_and_blocks_change_nothing(many_blocks, monkeypatch, turns, last, block):
    monkeypatch.setattr(P, "LAST_KEYS", last)
    rng = random.Random(turns)
    rows = talk(rng, range(90), texts=3) + [(700 + i, t, "user", f"same {t}") for i in range(30) for t in range(4)] + [(900, t, "user", "long") for t in range(60)]
    want = plain_nodes(plain_turns(rows))
    nodes = P.trie_nodes(P.paths_of(many_blocks.createDataFrame(rows, SCHEMA)), tree_turns=turns, block_ids=block)
    assert sorted((tuple(r) for r in nodes.collect()), key=repr) == want


def test_broadcast_or_salt(spark, monkeypatch):
    rng = random.Random(4)
    rows = talk(rng, range(120), texts=4)
    want = nodes_of(spark, rows, graft=False)
    monkeypatch.setattr(P, "BROADCAST_NODES", 0)
    assert nodes_of(spark, rows, graft=False) == want == plain_nodes(plain_turns(rows))


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "lost"), (1, None, "user", "b"), (1, None, "user", "a"), (1, 5, None, None), (1, 5, None, None), (1, 0, "", ""), (2, 0, None, ""),
        (2, 0, "user", "x" * 100_000), (-7, 3, "user", "a b"), (20, 0, "user", "q"), (41, 0, "user", "q"), (40, 0, "user", "z"),
    ]
    assert nodes_of(spark, rows) == plain_nodes(plain_grafts(plain_turns(rows)))
    turns = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS key", "1 AS path", "2 AS words", "3 AS ends", "4 AS leaf")
    assert sorted((tuple(r) for r in P.trie_nodes(P.paths_of(turns)).collect()), key=repr) == plain_nodes(plain_turns(rows))
    assert nodes_of(spark, rows[:1]) == [] and nodes_of(spark, rows[:0]) == []


def test_conversations_without_turns_end_at_the_root(spark):
    paths = spark.createDataFrame([(5, []), (3, []), (9, [("0" * 32, 2)])], "conv_id long, path array<struct<id: string, words: long>>")
    got = sorted((tuple(r) for r in P.trie_nodes(paths).collect()), key=lambda r: r[1])
    both, nine = (hashlib.sha256(t).hexdigest() for t in (b"3,5", b"9"))
    assert got == [(3, 0, None, 3, 1, 1, 0, both), (9, 1, 3, 1, 0, 1, 0, nine)]
