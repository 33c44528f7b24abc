"""Near duplicates by fast similarity sketching, banding and exact verification.

Sketch: in each of the first t rounds every shingle falls into a hashed bin with a value between the round's number and
the next, and a bin keeps its least value. Rounds go on until all bins are filled; rounds after the t-th send
all shingles to one bin each, so after 2 t rounds every coordinate is filled. Coordinates of two sets are
equal with the probability of their similarity, and concentrate around it.

Candidates: 32 bands of 4 coordinates. A link of similarity 0.75 is missed with probability (1 - 0.75**4)**32 < 6e-6.

Hot buckets: texts that are equal are one class from the start. Then each bucket links its members to a few hubs, not to
each other, the candidates are verified, and components formed. What then is open, buckets that
still hold several components, is compared in blocks of bounded size: only pairs of different components can matter,
and a class is sent once for each block that it meets. So no link between candidates is lost, and pairs are
never written out.

Verification compares the full shingle sets of both texts.

Edge cases. Null and empty texts, and texts without a word, have an empty set and are linked with nothing, not with
each other either. With fewer words than a shingle, all words are the one shingle. Repeated rows are one class; rows of one
id with different texts are documents of their own. A null id never is the smallest; a component of null ids only has
a null component_id, and all of it is kept. An empty table gives no rows. Extra columns are left out by
`near_duplicates` and kept by `keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshelf.llm.common import moved, ship_package
from tallyshelf.llm.graph import components
from tallyshelf.llm.shingles import mix, shingle_set
from tallyshelf.scratch import Scratch

# Documented parameters: words of a shingle, least similarity in percent, bins of a sketch, coordinates of a band.
WIDTH, PERCENT, BINS, ROWS = 5, 75, 128, 4
# Documented parameters: hubs of a bucket in a round, and rounds; classes and shingles of a block.
HUBS, HUB_ROUNDS = 2, 1
BLOCK_CLASSES, BLOCK_SHINGLES = 192, 1 << 19
ROUND = np.uint64(0xD1342543DE82EF95)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketch(hashes: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Least value of every bin. Later rounds never change a filled bin, so several rounds are done at once."""
    out = np.full(bins, EMPTY)
    at = 0
    with np.errstate(over="ignore"):
        while at < bins and (out == EMPTY).any():
            many = min(bins - at, max(1, 2048 // len(hashes)))
            rounds = np.arange(at, at + many, dtype=np.uint64)[:, None]
            z = mix(hashes[None, :] + (rounds + np.uint64(1)) * ROUND)
            values = (rounds << np.uint64(54)) | (z >> np.uint64(10))
            np.minimum.at(out, (z % np.uint64(bins)).astype(np.int64).ravel(), values.ravel())
            at += many
        for empty in np.flatnonzero(out == EMPTY):
            at = np.uint64(bins + int(empty))
            out[empty] = (at << np.uint64(54)) | (mix(hashes + (at + np.uint64(1)) * ROUND) >> np.uint64(10)).min()
    return out


def bands_of(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit bucket per band of `rows` coordinates."""
    parts = signature.reshape(-1, rows)
    with np.errstate(over="ignore"):
        bucket = mix(np.arange(len(parts), dtype=np.uint64) + ROUND)
        for i in range(rows):
            bucket = mix(bucket * ROUND + parts[:, i])
    return bucket.view(np.int64)


def _sketches(width: int, bins: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, bands = [], []
            for text in batch.column("text"):
                hashes = shingle_set(text.as_py(), width)
                sizes.append(len(hashes))
                bands.append(bands_of(sketch(hashes, bins), rows) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "key", "n", "bands"],
            )

    return run


def _similar(width: int, percent: int):
    """Keeps the pairs of texts that are similar enough. Neighbouring rows often share the first text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in batches:
            keep = []
            a, b = batch.column("a"), batch.column("b")
            for i, (one, two) in enumerate(zip(batch.column("text_a"), batch.column("text_b"), strict=True)):
                if a[i].as_py() != last:
                    last, left = a[i].as_py(), shingle_set(one.as_py(), width)
                right = shingle_set(two.as_py(), width)
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= percent * (len(left) + len(right) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["a", "b"])

    return run


def _common(sets: list[np.ndarray], columns: int = 1 << 13) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, from products of their incidence matrices, some columns at a time."""
    values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    column = np.cumsum(np.r_[True, values[1:] != values[:-1]]) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    common = np.zeros((len(sets), len(sets)))
    bounds = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + columns, columns))
    for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
        incidence = np.zeros((len(sets), columns), np.float32)
        incidence[owner[a:b], column[a:b] - i * columns] = 1
        common += incidence @ incidence.T
    return common


def _compare_blocks(width: int, percent: int):
    """Links between two blocks, or inside one, of classes of different components; no more than connect them."""
    def run(group: pa.Table) -> pa.Table:
        node, root, mine = (group.column(c).to_numpy() for c in ("node", "root", "mine"))
        sets = [shingle_set(t.as_py(), width) for t in group.column("text")]
        sizes = np.array([len(s) for s in sets])
        common = _common(sets)
        linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
        linked &= root[:, None] != root[None, :]
        if group.column("i")[0] != group.column("j")[0]:
            linked &= mine[:, None] != mine[None, :]
        found, leader = [], {r: r for r in root.tolist()}

        def top(r: int) -> int:
            while leader[r] != r:
                leader[r] = leader[leader[r]]
                r = leader[r]
            return r

        for x, y in zip(*(k.tolist() for k in np.nonzero(np.triu(linked))), strict=True):
            one, two = top(root[x].item()), top(root[y].item())
            if one != two:
                leader[one] = two
                found.append((node[x].item(), node[y].item()))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return run


def _digest(text: str):
    """Sixteen bytes that stand for the whole text, null for null."""
    return F.unhex(F.md5(F.col(f"`{text}`").cast("binary")))


class _Search:
    """The tables of one search: buckets of two or more classes, and the texts of these classes."""

    def __init__(self, docs: DataFrame, classes: DataFrame, scratch: Scratch, width: int, percent: int):
        self.scratch, self.width, self.percent = scratch, width, percent
        rows = classes.select("node", "n", F.explode("bands").alias("h"))
        sizes = rows.groupBy("h").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        self.buckets = scratch.table(rows.join(moved(sizes), "h"), "buckets")
        nodes = self.buckets.select("node").distinct()
        wanted = classes.select("node", "key", "first_id").join(moved(nodes), "node")
        texts = docs.select(F.col("doc_id").alias("first_id"), "key", "text").join(
            moved(wanted.withColumnRenamed("key", "its_key").withColumnRenamed("first_id", "its_id")),
            (F.col("key") == F.col("its_key")) & F.col("first_id").eqNullSafe(F.col("its_id")),
        )
        self.texts = scratch.table(texts.select("node", "text").dropDuplicates(["node"]), "texts")

    def near(self, a: str, b: str):
        """Sets of such sizes can be similar enough."""
        return 100 * F.least(a, b) >= self.percent * F.greatest(a, b)

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The links among pairs (a, b)."""
        left = self.texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        right = self.texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        rows = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        rows = rows.join(moved(right), "b").join(moved(left), "a").select("a", "text_a", "b", "text_b")
        return rows.mapInArrow(_similar(self.width, self.percent), "a long, b long")

    def links(self) -> DataFrame:
        """Links of the candidates, enough of them that every linked pair of classes is joined by a path."""
        rows, found = self.buckets.withColumn("root", F.col("node")), []
        for turn in range(HUB_ROUNDS):
            rows = self._with_hubs(rows, turn)
            hubs = rows.where("is_hub").select("h", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("root").alias("root_a"))
            met = hubs.join(moved(rows.withColumnRenamed("node", "b")), "h").where("root_a <> root")
            found.append(self.scratch.table(self.verified(met.where(self.near("n_a", "n")).select("a", "b")), "found"))
            rows = self._still_open(rows, reduce(DataFrame.union, found))
            if rows.isEmpty():
                break
        else:
            found.append(self.scratch.table(self._block_links(rows), "found"))
        return reduce(DataFrame.union, found)

    def _with_hubs(self, rows: DataFrame, turn: int) -> DataFrame:
        """Adds is_hub: about HUBS members of each bucket, that of the least hash for certain."""
        rows = rows.withColumn("order", F.xxhash64("node", "h", F.lit(turn)))
        least = rows.groupBy("h").agg(F.min("order").alias("least"))
        chosen = (F.col("order") == F.col("least")) | (F.pmod("order", F.col("size")) < HUBS - 1)
        return self.scratch.table(rows.join(moved(least), "h").withColumn("is_hub", chosen).drop("order", "least"), "hubs")

    def _still_open(self, rows: DataFrame, found: DataFrame) -> DataFrame:
        """The buckets that hold several components, without the hubs, which have met all others there."""
        roots = self.scratch.table(components(found, self.scratch), "roots")
        rows = rows.where("NOT is_hub").select("h", "node", "n").join(moved(roots), "node", "left")
        rows = rows.select("h", "node", "n", F.coalesce("root", "node").alias("root"))
        sizes = rows.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("size"))
        return self.scratch.table(rows.join(moved(sizes.where("lo <> hi").drop("lo", "hi")), "h"), "open")

    def _block_links(self, rows: DataFrame) -> DataFrame:
        """All links that are left, block by block.

        Classes that open buckets connect are a family. Its largest component needs no comparison inside. The rest, and that
        component, are cut into blocks of a bounded number of classes and shingles, and each block of the rest meets every
        block. A class is copied once per block it meets, not once per class.
        """
        star = rows.join(moved(rows.groupBy("h").agg(F.min("node").alias("a"))), "h").select("a", F.col("node").alias("b"))
        families = components(star, self.scratch).withColumnRenamed("root", "family")
        members = self.scratch.table(rows.select("node", "n", "root").distinct().join(moved(families), "node"), "members")
        parts = members.groupBy("family", "root").agg(F.count(F.lit(1)).alias("k"))
        largest = parts.groupBy("family").agg(F.max_by("root", F.struct("k", "root")).alias("largest"))
        members = members.join(largest, "family").withColumn("rest", F.col("root") != F.col("largest"))
        blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_SHINGLES))
        sizes = members.groupBy("family", "rest").agg(blocks.alias("blocks"))
        sizes = sizes.groupBy("family").agg(
            F.coalesce(F.max(F.when(F.col("rest"), F.col("blocks"))), F.lit(0)).alias("rests"),
            F.coalesce(F.max(F.when(~F.col("rest"), F.col("blocks"))), F.lit(0)).alias("cores"),
        )
        members = members.join(sizes, "family")
        mine = F.when(F.col("rest"), F.pmod(F.xxhash64("node"), "rests")).otherwise(F.col("rests") + F.pmod(F.xxhash64("node"), F.greatest("cores", F.lit(1))))
        members = members.withColumn("mine", mine.cast("long"))
        # Blocks of the rest are numbered first. Pairs (i, j), i <= j, with i a block of the rest.
        everyone = F.sequence(F.lit(0).cast("long"), (F.col("rests") + F.col("cores") - 1).cast("long"))
        of_rest = F.sequence(F.lit(0).cast("long"), (F.col("rests") - 1).cast("long"))
        members = members.where("rests > 0").withColumn("other", F.explode(F.when(F.col("rest"), everyone).otherwise(of_rest)))
        members = members.select("family", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "root")
        rows = members.join(moved(self.texts), "node").select("family", "i", "j", "mine", "node", "root", "text")
        return rows.groupBy("family", "i", "j").applyInArrow(_compare_blocks(self.width, self.percent), "a long, b long")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT,
    bins: int = BINS, rows: int = ROWS,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id it is linked with), kept, text_key (a digest)."""
    spark = docs.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    scratch = Scratch(spark)
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), _digest(text).alias("key"), F.col(f"`{text}`").alias("text"))
    made = docs.mapInArrow(_sketches(width, bins, rows), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key binary, n long, bands array<long>")
    sketches = scratch.table(made, "sketches")
    classes = sketches.where("n > 0").groupBy("key", "n", "bands").agg(F.min("doc_id").alias("first_id"))
    classes = scratch.table(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    links = _Search(docs, classes, scratch, width, percent).links()
    roots = scratch.table(components(links, scratch), "roots")
    linked = classes.select("node", "key", "first_id").join(moved(roots), "node", "left").select("key", "first_id", F.coalesce("root", "node").alias("root"))
    of_root = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_key = scratch.table(linked.join(moved(of_root), "root").select(F.col("key").alias("its_key"), "component_id"), "members")
    rows = sketches.select("doc_id", "n", "key").join(moved(of_key), (F.col("key") == F.col("its_key")) & (F.col("n") > 0), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    kept = F.col("doc_id").eqNullSafe(component)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"), F.col("key").alias("text_key"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that are kept, all columns; rows alike in id and text are one document."""
    kept = near_duplicates(docs, doc_id, text, **options).where("kept").select(F.col("doc_id").alias("kept_id"), "text_key").distinct()
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("id"), _digest(text).alias("twin"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.join(moved(kept), F.col("id").eqNullSafe(F.col("kept_id")) & F.col("twin").eqNullSafe(F.col("text_key")), "left_semi")
    return rows.dropDuplicates(["id", "twin"]).select("row.*")
