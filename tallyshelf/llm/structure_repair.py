"""Cheapest repair of a conversation's structure, by integer minimum over a graph of edits.

A conversation shall read (system)? then pairs of user and assistant, or be empty. Rows are kept, reroled to user or assistant, or
deleted, and empty user or assistant turns are inserted; see the costs below. Of the cheapest edits, those whose letters, in order,
are ASCII-least are made.

One integer weighs a way through the rows: its high digits are the cost, its low digits the letters. Each row has two octal digits in a
fixed place: (letter, 0), or (I, letter) after an insertion; two more are for insertions at the end. Digits rise with the
letters' ASCII codes, and no letter is 0, so unused places are zero and a shorter audit comes before its extensions. A row's digits never
are the beginning of other digits of that row, so comparing places compares audits. Weights of edits add up, and the least
sum in each of the four states (nothing yet, system, user, assistant) after each row is all that is needed: an ordinary
shortest way. One insertion a gap is enough: a second one could only bring back the state of before, and at the end of a lone system
turn deleting it is cheaper.

Rows beyond BLOCK begin a new block, whose first digit ranks what the earlier blocks wrote in the four states. So integers stay short
and time is linear in the rows, however long a conversation is.

Two passes over Spark's sorted rows. The first sees a few bytes a row, no texts: faults and the audit. The second meets
each conversation's audit before its rows and makes the repaired rows, or their digest, as they stream by. Texts are never
gathered; a conversation's edits are decided in one task, whose memory holds four letters a row.

Edge cases. A null role or text is one space, so a null text is blank and a null role has the initial space, which can't be kept. Rows without a
turn come first; rows of one turn go by role, then by a digest of role and text. Rows with a null conversation id are one conversation. A
conversation that only `ids` names has no rows: zeros, an empty audit, no repaired row. Role initials are compared as they are, so
`User` must be reroled. Very long texts are one row each. An empty table gives no rows. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyshelf.llm.common import ship_package
from tallyshelf.scratch import Scratch

# Costs, and letters in ASCII order.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LETTERS = "DIKR"
# The white space of texts, and what ends a sentence.
WHITE, ENDS = " \t\n\x0b\x0c\r", ".!?"
USER, ASSISTANT = "user", "assistant"
# Documented parameter: rows of a block, so the longest integer has 6 bits a row and a few more.
BLOCK = 64

# States: nothing yet, system, user, assistant. Initials that may follow each, and the state after them.
EMPTY, SYSTEM, ASKED, ANSWERED = range(4)
FOLLOWS = ({"s": SYSTEM, "u": ASKED}, {"u": ASKED}, {"a": ANSWERED}, {"u": ASKED})
# The state after a rerole or an insertion, and the insertions that end a conversation in each state.
NEXT, MISSING = (ASKED, ASKED, ANSWERED, ASKED), (0, 2, 1, 0)
D, I, K, R = (LETTERS.index(c) + 1 for c in LETTERS)
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def cheapest(rows: Iterator[tuple[str, bool, bool]]) -> tuple[int, str]:
    """Cost and audit of the cheapest edits of (role initial, must be deleted, is truncated) rows."""
    # What each state has cost, and for each block and state the state before it and the letters.
    costs: dict[int, int] = {EMPTY: 0}
    blocks: list[dict[int, tuple[int, str]]] = []
    ranks = {EMPTY: 0}
    rows = list(rows)
    for first in range(0, max(1, len(rows)), BLOCK):
        part = rows[first : first + BLOCK]
        places = 1 + 2 * len(part) + 2
        best = {s: (costs[s] << 3 * places) | (ranks[s] << 3 * (places - 1)) for s in costs}
        for i, (initial, doomed, cut) in enumerate(part):
            one, two, cost = 3 * (places - 2 - 2 * i), 3 * (places - 3 - 2 * i), 3 * places
            kept = (TRUNCATED * cut) << cost
            after: dict[int, int] = {}
            for state, weight in best.items():
                # The row alone, then with an insertion before it.
                for at, letter, so_far in ((state, one, weight), (NEXT[state], two, weight + (INSERT << cost) + (I << one))):
                    ways = [(at, (DELETE << cost) + (D << letter))]
                    if not doomed:
                        ways.append((NEXT[at], (REROLE << cost) + kept + (R << letter)))
                        if initial in FOLLOWS[at]:
                            ways.append((FOLLOWS[at][initial], kept + (K << letter)))
                    for to, edit in ways:
                        if to not in after or so_far + edit < after[to]:
                            after[to] = so_far + edit
            best = after
        if first + BLOCK >= len(rows):
            for state, n in enumerate(MISSING):
                if state in best:
                    best[state] += n * INSERT << 3 * places
                    best[state] += sum(I << 3 * (1 - j) for j in range(n))
            end = min(best, key=best.__getitem__)
            best = {end: best[end]}
        order = {rank: s for s, rank in ranks.items()}
        written = {}
        for state, weight in best.items():
            digits = [(weight >> 3 * (places - 1 - j)) & 7 for j in range(places)]
            written[state] = (order[digits[0]], "".join(LETTERS[d - 1] for d in digits[1:] if d))
        blocks.append(written)
        costs = {s: w >> 3 * places for s, w in best.items()}
        by_audit = sorted(best, key=lambda s: best[s] & ((1 << 3 * places) - 1))
        ranks = {s: rank for rank, s in enumerate(by_audit)}
    (state,) = costs
    cost, letters = costs[state], []
    for written in reversed(blocks):
        state, part = written[state]
        letters.append(part)
    return cost, "".join(reversed(letters))


class Repair:
    """Follows an audit row by row: `insertions()` gives the roles to insert before the next row, `row` what becomes of it."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, EMPTY

    def insertions(self) -> Iterator[str]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            yield USER if self.state == ASKED else ASSISTANT

    def row(self, role: str) -> str | None:
        letter = self.audit[self.at]
        self.at += 1
        if letter == "D":
            return None
        if letter == "K":
            self.state = FOLLOWS[self.state][role[:1]]
            return role
        self.state = NEXT[self.state]
        return USER if self.state == ASKED else ASSISTANT


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _by_conversation(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Runs of rows with one first value, each to be used up before the next."""
    row = next(rows, None)

    def run(conv: object) -> Iterator[tuple]:
        nonlocal row
        while row is not None and row[0] == conv:
            held, row = row, next(rows, None)
            yield held[1:]

    while row is not None:
        conv = row[0]
        yield conv, run(conv)


def _batched(rows: Iterator[tuple], schema: pa.Schema, most: int, size: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    room = most
    for row in rows:
        held.append(row)
        room -= 64 + size(row)
        if room <= 0:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, room = [], most
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _judged(rows: Iterator[tuple]) -> tuple:
    """gaps, blank, duplicate, truncated, illegal, cost and audit of a conversation's rows, in order."""
    faults = {"blank": 0, "duplicate": 0, "truncated": 0}
    low = high = turn_before = initial_before = None
    turns = illegal = 0
    edited: list[tuple[str, bool, bool]] = []
    for here, turn, initial, blank, seen, cut in rows:
        if not here:
            continue
        fault = "blank" if blank else "duplicate" if seen else "truncated" if cut else None
        if fault:
            faults[fault] += 1
        if turn is not None and turn != turn_before:
            turns, turn_before, high = turns + 1, turn, turn
            low = turn if low is None else low
        if initial_before is not None and (initial_before, initial) not in LEGAL:
            illegal += 1
        initial_before = initial
        edited.append((initial, fault in ("blank", "duplicate"), fault == "truncated"))
    cost, audit = cheapest(edited)
    return (high - low + 1 - turns if turns else 0, *faults.values(), illegal, cost, audit)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _judge(schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((conv, *_judged(rows)) for conv, rows in _by_conversation(_rows(batches)))
        yield from _batched(found, schema, 4_000_000, lambda r: len(r[-1]))

    return run


def _repaired(conv: object, rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conversation, position, role, text, letter) of the repaired rows. The audit comes before the rows."""
    audit = next(rows)[1]
    repair, position = Repair(audit), 0
    for _, _, role, text, *_ in rows:
        for inserted in repair.insertions():
            yield conv, position, inserted, "", "I"
            position += 1
        was = repair.row(role)
        if was is not None:
            yield conv, position, was, text, repair.audit[repair.at - 1]
            position += 1
    for inserted in repair.insertions():
        yield conv, position, inserted, "", "I"
        position += 1


def _repair(schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = (row for conv, rows in _by_conversation(_rows(batches)) for row in _repaired(conv, rows))
        yield from _batched(made, schema, 4_000_000, lambda r: 4 * len(r[3]))

    return run


def _digested(schema: pa.Schema) -> Callable:
    def digest(conv: object, rows: Iterator[tuple]) -> tuple:
        found, between, report = hashlib.sha256(), b"", next(rows)
        for _, _, role, text, _ in _repaired(conv, chain([report], rows)):
            found.update(between + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            between = b"\n"
        return conv, *report[4:], report[1], found.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched((digest(c, r) for c, r in _by_conversation(_rows(batches))), schema, 4_000_000, lambda r: len(r[-2]))

    return run


def _spaced(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(" "))


def _digest() -> Column:
    """16 bytes of role and text."""
    return F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))


class Repairs:
    """Repairs of conversations: `report` has one row per conversation, `rows` and `digests` are made from it and the texts."""

    def __init__(
        self, conversations: DataFrame, ids: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role",
        text: str = "text", scratch: Scratch | None = None,
    ):
        self.spark = conversations.sparkSession
        ship_package(self.spark)
        self.scratch = scratch or Scratch(self.spark)
        self.source = conversations.select(
            F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").cast("bigint").alias("turn"), _spaced(role).alias("role"), _spaced(text).alias("text"),
        ).withColumn("digest", _digest())
        self.ids = None if ids is None else ids.select(F.col(f"`{conv}`").alias("conv_id")).distinct()
        self.key = self.source.schema["conv_id"]
        self.report = self.scratch.table(self._report(), "repairs")

    def _report(self) -> DataFrame:
        body = F.rtrim(F.col("text"), F.lit(WHITE))
        narrow = self.source.select(
            "conv_id", F.lit(True).alias("here"), "turn", "role", F.substring("role", 1, 1).alias("initial"), "digest", (body == "").alias("blank"),
            (~F.right(body, F.lit(1)).isin(*ENDS)).alias("cut"),
        )
        if self.ids is not None:
            narrow = narrow.unionByName(self.ids.withColumn("here", F.lit(False)), allowMissingColumns=True)
        # Partitioned by conversation once; the window needs no other partitioning.
        seen = F.row_number().over(Window.partitionBy("conv_id", "digest").orderBy(F.col("turn").asc_nulls_first())) > 1
        narrow = narrow.repartition("conv_id").withColumn("seen", seen)
        ordered = narrow.sortWithinPartitions("conv_id", "here", F.col("turn").asc_nulls_first(), "role", "digest")
        fields = [self.key, *[T.StructField(n, T.LongType()) for n in COUNTS], T.StructField("audit", T.StringType())]
        schema = T.StructType(fields)
        return ordered.select("conv_id", "here", "turn", "initial", "blank", "seen", "cut").mapInArrow(_judge(to_arrow_schema(schema)), schema)

    def _with_audits(self) -> DataFrame:
        audits = self.report.withColumn("here", F.lit(False))
        rows = self.source.withColumn("here", F.lit(True)).unionByName(audits, allowMissingColumns=True)
        ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "here", F.col("turn").asc_nulls_first(), "role", "digest")
        return ordered.select("conv_id", "here", "audit", "role", "text", *COUNTS)

    @property
    def rows(self) -> DataFrame:
        """conv_id, position (from 0), role, text, and the letter of the edit that left the row there: K, R or I."""
        kinds = (("position", T.LongType()), ("role", T.StringType()), ("text", T.StringType()), ("edit", T.StringType()))
        schema = T.StructType([self.key, *[T.StructField(n, k) for n, k in kinds]])
        return self._with_audits().mapInArrow(_repair(to_arrow_schema(schema)), schema)

    @property
    def digests(self) -> DataFrame:
        """The report, with repaired_sha256 of the repaired `role:text` rows joined by newlines."""
        schema = T.StructType([*self.report.schema.fields, T.StructField("repaired_sha256", T.StringType())])
        return self._with_audits().mapInArrow(_digested(to_arrow_schema(schema)), schema)
