import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import pytest

from tallyshelf.llm import structure_repair as S
from tallyshelf.llm.registry import damaged
from tallyshelf.llm.structure_repair import Repairs, cheapest

WHITE, NAMES = " \t\n\x0b\x0c\r", {"u": "user", "a": "assistant"}
SCHEMA = "conv_id long, turn long, role string, text string"


def ways(rows):
    """Every sequence of edits with up to two insertions in a gap: (cost, audit, initials)."""
    inserts = ["", "u", "a", "uu", "ua", "au", "aa"]
    edits = []
    for initial, doomed, cut in rows:
        each = [(2, "D", "")]
        if not doomed:
            each += [(5 * cut, "K", initial), (1 + 5 * cut, "R", "u"), (1 + 5 * cut, "R", "a")]
        edits.append(each)
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        if sum(map(len, gaps)) > 3:
            continue
        for chosen in itertools.product(*edits):
            cost = 5 * sum(map(len, gaps)) + sum(c for c, _, _ in chosen)
            audit = "".join("I" * len(g) + e[1] for g, e in zip(gaps, chosen, strict=False)) + "I" * len(gaps[-1])
            yield cost, audit, "".join(g + e[2] for g, e in zip(gaps, chosen, strict=False)) + gaps[-1]


def brute(rows):
    return min((c, a, said) for c, a, said in ways(rows) if re.fullmatch("(s?(ua)+)?", said))


def random_rows(rng, n):
    return [(rng.choice("suauaua x"), rng.random() < 0.15, rng.random() < 0.2) for _ in range(n)]


@pytest.mark.parametrize("n", range(4))
def test_all_short_conversations(n):
    for rows in itertools.product([(c, d, t) for c in "sua " for d in (False, True) for t in (False, True)], repeat=n) if n < 3 else ():
        assert cheapest(rows) == brute(rows)[:2]
    rng = random.Random(n)
    for _ in range(60 if n == 3 else 0):
        rows = random_rows(rng, 3)
        assert cheapest(rows) == brute(rows)[:2]


def plain(rows):
    """By a table of texts instead of integers: the least (cost, audit) that ends each prefix in each state."""
    rows = list(rows)

    @cache
    def best(i, state):
        found = []
        if i == len(rows):
            found = [(0, "")] if state in (S.EMPTY, S.ANSWERED) else []
        else:
            initial, doomed, cut = rows[i]
            found.append((2, "D", i + 1, state))
            if not doomed:
                found.append((1 + 5 * cut, "R", i + 1, S.NEXT[state]))
                if initial in S.FOLLOWS[state]:
                    found.append((5 * cut, "K", i + 1, S.FOLLOWS[state][initial]))
            found = [(c + best(j, s)[0], e + best(j, s)[1]) for c, e, j, s in found]
        if inserting[-1]:
            inserting.append(False)
            after = best.__wrapped__(i, S.NEXT[state])
            inserting.pop()
            found.append((5 + after[0], "I" + after[1]))
        return min(found, default=(10**9, ""))

    inserting = [True]
    return best(0, S.EMPTY)


def test_blocks_change_nothing(monkeypatch):
    rng = random.Random(5)
    for n in (5, 8, 13, 40, 200):
        rows = random_rows(rng, n)
        want = plain(rows)
        for block in (1, 2, 3, 7, 64, 1000):
            monkeypatch.setattr(S, "BLOCK", block)
            assert cheapest(rows) == want


def test_long_conversations_are_linear():
    rng = random.Random(6)
    cost, audit = cheapest(random_rows(rng, 100_000))
    assert len(audit) >= 100_000 and cost > 0


def harm(conv, turn):
    return zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20


def plain_repairs(rows):
    """conv_id -> the whole row of the query, row by row in Python, edits by the plain table."""
    out, by = {}, {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, [])
        role, text, h = " " if role is None else role, " " if text is None else text, harm(conv, turn)
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        by[conv] += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    for conv, found in by.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        turns = [t for t, _, _ in found if t is not None]
        seen, faults = set(), []
        for _, role, text in found:
            body = text.rstrip(WHITE)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        starts = [r[1][:1] for r in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(starts))
        cost, audit = plain([(s, f in ("blank", "duplicate"), f == "truncated") for s, f in zip(starts, faults, strict=True)])
        said, queue = [], list(found)
        for letter in audit:
            wanted = "a" if said and said[-1][0][:1] == "u" else "u"
            if letter == "I":
                said.append((NAMES[wanted], ""))
                continue
            _, role, text = queue.pop(0)
            if letter != "D":
                said.append((role if letter == "K" else NAMES[wanted], text))
        assert not queue and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in said))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def repaired(spark, rows):
    turns = spark.createDataFrame(rows, SCHEMA)
    got = Repairs(damaged(turns), ids=turns).digests.collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: tuple(r)[1:] for r in got}


def test_odd_conversations(spark):
    texts = ["Hello.", "Hi!", "cut off", "", " \t\n", None, "Same?", "Same?", "x" * 30_000 + ".", "漢字。", "end. \x0b\n"]
    rng = random.Random(7)
    rows = []
    for conv in [None, -3, 0, *range(1, 120)]:
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([turn, turn, 2 * turn, 3, None]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "User", "", None]), rng.choice(texts)))
    rows += [(500, t, ("user", "assistant")[t % 2], f"Turn {t // 3}.") for t in range(700)]
    assert repaired(spark, rows) == plain_repairs(rows)


def test_only_dropped_rows_and_empty_tables(spark):
    dropped = next((c, t) for c in range(100) for t in range(9) if harm(c, t) == 0)
    got = repaired(spark, [(*dropped, "user", "Gone.")])
    assert got == {dropped[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert Repairs(spark.createDataFrame([], SCHEMA)).report.count() == 0


def test_rows_after_repair_and_clashing_columns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "So?"), (2, 0, "assistant", "Well."), (3, 0, "tool", "Yes.")]
    turns = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS here", "'y' AS digest", "'z' AS seen", "0 AS cost", "'q' AS audit")
    repairs = Repairs(turns.withColumnRenamed("conv_id", "id"), conv="id")
    got = [tuple(r) for r in repairs.rows.orderBy("conv_id", "position").collect()]
    assert [r[:4] for r in got if r[0] == 1] == [(1, 0, "user", "Hi."), (1, 1, "assistant", "So?")] and [r[4] for r in got if r[0] == 1] == ["K", "R"]
    assert {r.conv_id: (r.cost, r.audit) for r in repairs.report.collect()} == {1: (3, "KDR"), 2: (2, "D"), 3: (2, "D")}


def test_text_ids(spark):
    turns = spark.createDataFrame([("a", 0, "user", "Hi."), ("", 0, "assistant", "Hm.")], "conv_id string, turn long, role string, text string")
    assert sorted((r.conv_id, r.audit) for r in Repairs(turns).report.collect()) == [("", "D"), ("a", "D")]
