"""The prefix trie of conversations, by adaptive radix trees over fixed-width big-endian turn ids.

A turn's id is 16 bytes, the digest of its role and text read as a big-endian number, so a conversation is a key of 16 bytes a turn, and
no table of ids is joined. A node of the trie is a distinct sequence of first turns. Radix trees branch at bytes; only places that
are multiples of 16 bytes are turns and give nodes, also those inside a compressed run.

Equal conversations are one key, so a hot one is one row. Keys are range-partitioned and sorted; a task cuts its keys into chunks of
TREE_TURNS turns and builds a tree of each, so memory doesn't depend on the size of a partition. Keys of a node
lie side by side, so a node that others share lies on the way to a chunk's first or last key. Those two ways stay open: they go on as keys,
with the sums of what is closed below each depth, to the next level's trees, until one tree holds them all. A hot first turn thus spreads over as
many tasks as its continuations fill, and only a few nodes a chunk meet elsewhere. A closed child of an open node learns
that node's smallest member by a join with the few open ones.

The conversations that end at a node are hashed in ascending order without being gathered: ids are range-sorted, each task
hashes what lies wholly inside it, and the texts of runs that go on in other tasks are hashed block by block.

Edge cases. Null roles and texts are empty. Rows come by turn, those without one first, rows of one turn by a digest of role and text;
repeated rows are turns of their own. Rows without a conversation id are in no conversation. Without
conversations there is no node, the root included. A conversation without turns ends at the root. Texts of any length are digested whole;
a conversation's ids and word counts are one row, 24 bytes a turn. Extra columns are left out. Ids are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyshelf.llm.common import ship_package, text_of, word_count
from tallyshelf.llm.radix_tree import Tree, shared as _shared
from tallyshelf.scratch import Scratch

# Fixed value: bytes of a turn's id.
WIDTH = 16
# Documented parameters: turns of the keys of one tree, keys of the last tree that closes all nodes, ids hashed as one block, and open
# nodes up to which they may be broadcast.
TREE_TURNS, LAST_KEYS, BLOCK_IDS, BROADCAST_NODES = 100_000, 20_000, 50_000, 200_000
NO_ENDS = hashlib.sha256(b"").hexdigest()

# A key and, for its depths from `base` to its own, what is known of the node there: conversations that end at it, the first of them,
# the digest of all, and the closed sums below it.
SEQUENCE = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("words", T.ArrayType(T.LongType())), T.StructField("base", T.IntegerType()),
    T.StructField("ends", T.ArrayType(T.LongType())), T.StructField("first", T.ArrayType(T.LongType())),
    T.StructField("sha", T.ArrayType(T.StringType())), T.StructField("below", T.ArrayType(T.ArrayType(T.LongType()))),
])
# Closed nodes are rows of the result, but for the parent's id where `parent_key` stands for it; open ways are sequences of the next level.
FOUND = T.StructType([
    T.StructField("closed", T.BooleanType()), T.StructField("own_key", T.BinaryType()), T.StructField("parent_key", T.BinaryType()),
    T.StructField("node", T.StructType([T.StructField(n, T.LongType()) for n in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
                                       + [T.StructField("ends_sha256", T.StringType())])),
    T.StructField("open", SEQUENCE),
])


def paths_of(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id and `path`: its turns in order, each an id (hexadecimal) and the number of words."""
    rows = conversations.select(
        F.col(f"`{conv}`").cast("bigint").alias("conv_id"), F.col(f"`{turn}`").cast("bigint").alias("turn"), text_of(role).alias("role"), text_of(text).alias("text"),
    ).where(F.col("conv_id").isNotNull())
    ident = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    entry = F.struct(F.col("turn").isNotNull().alias("dated"), "turn", ident.alias("id"), word_count(F.col("text")).alias("words"))
    path = F.transform(F.sort_array(F.collect_list(entry)), lambda e: F.struct(e["id"].alias("id"), e["words"].alias("words")))
    return rows.groupBy("conv_id").agg(path.alias("path"))


def _digest_of(key: bytes) -> bytes:
    return hashlib.md5(key).digest()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


# Conversations that end at one sequence.

RUN = T.StructType([
    T.StructField("leaf", T.BinaryType()), T.StructField("first", T.LongType()), T.StructField("ends", T.LongType()),
    T.StructField("sha", T.StringType()), T.StructField("ids", T.StringType()),
])


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Of sorted (leaf, id) rows: hashed runs, and blocks of text of those that are long or may go on in other tasks."""
    schema = to_arrow_schema(RUN)
    out: list[tuple] = []
    leaf, ids, whole = None, [], False

    def block(sha: bool) -> None:
        text = ",".join(map(str, ids))
        out.append((leaf, ids[0], len(ids), hashlib.sha256(text.encode()).hexdigest() if sha else None, None if sha else text))

    for own, conv in _rows(batches):
        if own != leaf:
            if ids:
                block(whole)
            # The first run may have begun in another task.
            whole = leaf is not None
            leaf, ids = own, []
        ids.append(conv)
        if len(ids) == most:
            block(False)
            ids, whole = [], False
        if len(out) >= 2000 or (out and out[-1][2] > 1000):
            yield _batch(out, schema)
            out.clear()
    if ids:
        block(False)
    if out:
        yield _batch(out, schema)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash of the blocks of each leaf, as they stream by in order."""
    schema = to_arrow_schema(RUN)
    out: list[tuple] = []
    leaf, first, count, hashed = None, None, 0, None
    for own, start, ends, _, text in _rows(batches):
        if own != leaf:
            if leaf is not None:
                out.append((leaf, first, count, hashed.hexdigest(), None))
            leaf, first, count, hashed = own, start, 0, hashlib.sha256()
        hashed.update(f"{',' if count else ''}{text}".encode())
        count += ends
    if leaf is not None:
        out.append((leaf, first, count, hashed.hexdigest(), None))
    if out:
        yield _batch(out, schema)


def _ends(members: DataFrame, scratch: Scratch, block_ids: int) -> DataFrame:
    """One row for each distinct sequence: its smallest conversation `first`, number of `ends`, and the `sha` of their ids."""
    ordered = members.select(F.unhex(F.md5("key")).alias("leaf"), "conv_id").repartitionByRange("leaf", "conv_id").sortWithinPartitions("leaf", "conv_id")
    runs = scratch.table(ordered.mapInArrow(partial(_runs, most=block_ids), RUN), "runs")
    blocks = runs.where(F.col("sha").isNull()).repartition("leaf").sortWithinPartitions("leaf", "first")
    return runs.where(F.col("sha").isNotNull()).union(blocks.mapInArrow(_joined, RUN)).drop("leaf", "ids")


# Trees.


class Sums:
    """What is known of a node, or of all that hangs below a place of the tree."""

    __slots__ = ("members", "first", "children", "leaves", "saved", "pending")

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.members, self.first, self.children, self.leaves, self.saved = 0, None, 0, 0, 0
        # Closed nodes whose parent is the next node up.
        self.pending: list[list] = []

    def add(self, members: int, first: int | None, children: int, leaves: int, saved: int) -> None:
        self.members += members
        if first is not None and (self.first is None or first < self.first):
            self.first = first
        self.children += children
        self.leaves += leaves
        self.saved += saved


class Value:
    """A sequence in the tree: conversations that end there, and closed sums below an open node, merged from several chunks."""

    __slots__ = ("ends", "first", "sha", "below", "below_first")

    def __init__(self):
        self.ends, self.first, self.sha, self.below, self.below_first = 0, None, None, [0, 0, 0, 0], None

    def merge(self, ends: int, first: int | None, sha: str | None, below: list | None) -> None:
        self.ends += ends
        self.first = first if self.first is None or (first is not None and first < self.first) else self.first
        self.sha = sha or self.sha
        if below:
            self.below = [a + b for a, b in zip(self.below, below[:4], strict=True)]
            if below[4] is not None and (self.below_first is None or below[4] < self.below_first):
                self.below_first = below[4]


class Chunk:
    """The tree of some sequences, and its nodes at the depths of turns."""

    def __init__(self, whole: bool, keep_keys: bool):
        self.whole, self.keep_keys = whole, keep_keys
        self.tree, self.words, self.first, self.last, self.turns = Tree(), {}, None, b"", 0

    def add(self, key: bytes, words: list[int], base: int, ends: list, first: list, sha: list, below: list) -> None:
        for i, values in enumerate(zip(ends, first, sha, below, strict=True), base):
            node = self.tree.add(key[: WIDTH * i])
            if node.value is None:
                node.value = Value()
            node.value.merge(*values)
        for i, n in enumerate(words):
            self.words[key[WIDTH * i : WIDTH * (i + 1)]] = n
        self.first, self.last = key if self.first is None else self.first, key
        self.turns += 1 + len(words)

    def nodes(self) -> Iterator[tuple]:
        """FOUND rows, children before parents, and at the end the open ways to the first and the last key."""
        root, path = self.tree.root, bytearray(self.tree.root.run)
        # What is open on the way to the first key, and beside it on the way to the last, from the deepest up.
        ways: tuple[list, list] = ([], [])
        # Node, the depth in bytes where it begins and ends, its children yet to visit, and the sums of those visited.
        stack = [(root, -1, len(path), root.items(), Sums())]
        while stack:
            node, start, end, kids, sums = stack[-1]
            step = next(kids, None)
            del path[end:]
            if step is not None:
                byte, kid = step
                path.append(byte)
                path += kid.run
                stack.append((kid, end, len(path), kid.items(), Sums()))
                continue
            stack.pop()
            yield from self._turns(path, node.value, start, sums, ways)
            if stack:
                above = stack[-1][4]
                above.add(sums.members, sums.first, sums.children, sums.leaves, sums.saved)
                above.pending += sums.pending
        for key, way in zip((self.first, self.last), ways, strict=True):
            if way:
                depths, *values = zip(*reversed(way), strict=True)
                key = key[: WIDTH * depths[-1]]
                words = [self.words[key[i : i + WIDTH]] for i in range(0, len(key), WIDTH)]
                yield False, None, None, None, (key, words, depths[0], *map(list, values))

    def _turns(self, path: bytearray, value: Value | None, start: int, sums: Sums, ways: tuple[list, list]) -> Iterator[tuple]:
        """The nodes after `start` of one tree node, from the deepest up; `sums` becomes what hangs below the place above them.

        Keys come sorted, so the nodes that other chunks share lie on the way to the first or the last one.
        """
        end = len(path)
        on_first, on_last = (-1, -1) if self.whole else (_shared(path, self.first, 0), _shared(path, self.last, 0))
        for at in range(end - end % WIDTH, start, -WIDTH):
            here = value if at == end else None
            if at <= on_first or at <= on_last:
                below, first = [sums.members, sums.children, sums.leaves, sums.saved], sums.first
                if here:
                    below = [a + b for a, b in zip(below, here.below, strict=True)]
                    first = min((x for x in (first, here.below_first) if x is not None), default=None)
                own = _digest_of(bytes(path[:at]))
                for row, key in sums.pending:
                    yield True, key, own, tuple(row), None
                known = (here.ends, here.first, here.sha) if here else (0, None, None)
                ways[at > on_first].append((at // WIDTH, *known, [*below, first]))
                sums.clear()
                continue
            if here:
                sums.add(here.ends, here.first, 0, 0, 0)
                sums.add(here.below[0], here.below_first, *here.below[1:])
            if not sums.children:
                sums.leaves = 1
            sums.saved += (sums.members - 1) * (self.words[bytes(path[at - WIDTH : at])] if at else 0)
            row = [sums.first, at // WIDTH, None, sums.members, sums.children, sums.leaves, sums.saved, (here and here.sha) or NO_ENDS]
            for child, key in sums.pending:
                child[2] = sums.first
                yield True, key, None, tuple(child), None
            sums.pending, sums.children = [(row, _digest_of(bytes(path[:at])) if self.keep_keys else None)], 1
            if not at:
                yield True, sums.pending[0][1], None, tuple(row), None


def _grow(whole: bool, keep_keys: bool, most: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(FOUND)
        out: list[tuple] = []
        chunk = Chunk(whole, keep_keys)

        def found() -> Iterator[tuple]:
            nonlocal chunk
            for row in _rows(batches):
                chunk.add(*row)
                if chunk.turns >= most and not whole:
                    yield from chunk.nodes()
                    chunk = Chunk(whole, keep_keys)
            if chunk.turns:
                yield from chunk.nodes()

        for row in found():
            out.append(row)
            if len(out) >= 5000:
                yield _batch_of(out, schema)
                out.clear()
        if out:
            yield _batch_of(out, schema)

    return run


def _batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """FOUND rows, whose structures are given as tuples."""
    names = {f.name: [g.name for g in f.type] for f in schema if pa.types.is_struct(f.type)}
    columns = []
    for column, field in zip(zip(*rows, strict=True), schema, strict=True):
        if field.name in names:
            column = [None if c is None else dict(zip(names[field.name], c, strict=True)) for c in column]
        columns.append(pa.array(column, field.type))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def trie_nodes(
    paths: DataFrame, scratch: Scratch | None = None, tree_turns: int = TREE_TURNS, block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """One row for each node of the trie of `paths` (conv_id, path): conv_id (its smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = paths.sparkSession
    ship_package(spark)
    scratch = scratch or Scratch(spark)
    key = F.unhex(F.array_join(F.transform("path", lambda t: t["id"]), ""))
    members = scratch.table(paths.select("conv_id", key.alias("key"), F.transform("path", lambda t: t["words"]).alias("words")), "members")
    ends = _ends(members, scratch, block_ids)
    known = [F.array(c).alias(c) for c in ("ends", "first", "sha")] + [F.array(F.lit(None).cast("array<bigint>")).alias("below")]
    sequences = members.join(ends, members["conv_id"] == ends["first"]).select("key", "words", F.size("words").alias("base"), *known)
    # Written, as range partitioning reads its input twice.
    sequences = scratch.table(sequences, "sequences")
    levels: list[DataFrame] = []
    before, left = None, sequences.count()
    while left:
        # One task closes the last open ways: two for each chunk of the level before. More levels follow only while they make them fewer.
        whole = bool(levels) and (left <= LAST_KEYS or left > before // 2)
        ordered = sequences.repartition(1) if whole else sequences.repartitionByRange("key")
        found = scratch.table(ordered.sortWithinPartitions("key").mapInArrow(_grow(whole, bool(levels), tree_turns), FOUND), f"level{len(levels)}")
        levels.append(found)
        sequences = found.where(~F.col("closed")).select("open.*")
        before, left = left, sequences.count()
    return _resolved(levels, spark, scratch)


def _resolved(levels: list[DataFrame], spark: SparkSession, scratch: Scratch) -> DataFrame:
    """The closed nodes of all levels, each with its parent's id."""
    if not levels:
        return spark.createDataFrame([], FOUND["node"].dataType)
    closed = levels[0]
    for level in levels[1:]:
        closed = closed.union(level)
    closed = closed.where("closed")
    columns = [F.col(f"node.{f.name}").alias(f.name) for f in FOUND["node"].dataType.fields]
    done = closed.where(F.col("parent_key").isNull()).select(*columns)
    # Nodes that were open once: few a chunk. A hot one's children meet it in many tasks, as it is broadcast or salted.
    parents = scratch.table(closed.where(F.col("own_key").isNotNull()).select(F.col("own_key").alias("parent_key"), F.col("node.conv_id").alias("of_parent")), "parents")
    asked = closed.where(F.col("parent_key").isNotNull())
    if parents.count() <= BROADCAST_NODES:
        found = asked.join(F.broadcast(parents), "parent_key")
    else:
        salts = 64
        parents = parents.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        found = asked.withColumn("salt", F.pmod(F.xxhash64("node.conv_id", "node.depth"), F.lit(salts)).cast("int")).join(parents, ["parent_key", "salt"])
    found = found.select(*[F.col("of_parent").alias(n) if n == "parent_conv_id" else c for n, c in zip(FOUND["node"].dataType.names, columns, strict=True)])
    return done.union(found)
