"""Toxicity: a linear classifier over character n-grams whose features are scaled by naive Bayes log-count ratios.

A text's features are its distinct character n-grams, of lower-cased text with white space runs as one space, hashed to slots.
From the labelled sample each slot gets the log of the ratio between its share of the toxic texts' features and its share of
the clean texts'. A logistic regression is then fitted on features that have their ratio for a value, so that an n-gram the
classes share says next to nothing however often it is seen. The model is one weight a slot: the regression's times the ratio.
Toxic and clean rows are sampled apart, and the intercept is moved back to the share of toxic labels among all of them.

Fitting sees a bounded sample of labelled rows (ROWS of each class, CHARS code points in all, whole texts) in one task;
the share of toxic labels, and every score, are of all rows and whole texts. Scoring is one pass without a shuffle.

Edge cases. Null and empty texts have no features: their score is the intercept's. Null labels and labels without a document
teach nothing; of several documents with one id, one text is taken, and a label that is given as both 0 and 1 counts as 1. A
null id counts as empty text where ids are split, and a label without an id has no document. Repeated rows are scored alike. If
either class has no row to learn from, the score is the share of toxic labels, 0 without any label. An empty table gives no
rows. Very long texts are read in blocks of BLOCK code points that overlap, and scored whole. Extra columns are left out.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyshelf.llm.common import pieces, ship_package
from tallyshelf.llm.shingles import mix
from tallyshelf.scratch import Scratch

# Documented parameters: rows of each class in the sample and their code points in all; sizes of n-grams, slots, texts that hold an
# n-gram at least, and code points of a block.
ROWS, CHARS = 1500, 12_000_000
GRAMS, SLOTS, FEW, BLOCK = (2, 3, 4, 5), 1 << 20, 2, 1_000_000
# Documented parameters of training: smoothing of the ratios, steps at least and passes over the sample at least, texts of a step,
# its size, decay.
SMOOTH, STEPS, PASSES, STEP, RATE, DECAY = 1.0, 250, 5, 64, 0.1, 1e-3
# Documented parameters: the score from which a text is toxic, and bytes of text that a task scores at a time.
TOXIC, BYTES = 0.3, 8_000_000


def _block_slots(codes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The distinct slots of a run of code points, in the order they first occur or any other that its text decides."""
    found = []
    with np.errstate(over="ignore"):
        grams = np.zeros(len(codes), np.uint64)
        for n in range(1, GRAMS[-1] + 1):
            grams = grams[: len(codes) - n + 1] * np.uint64(1_000_003) + codes[n - 1 :]
            if n in GRAMS:
                found.append(mix(grams + np.uint64(n)) & np.uint64(SLOTS - 1))
            if len(grams) < 2:
                break
    slots = np.concatenate(found).astype(np.int32) if found else np.empty(0, np.int32)
    at = np.arange(len(slots), dtype=np.int32)
    # The last place that holds a slot owns it.
    owner[slots] = at
    return slots[owner[slots] == at]


def slots_of(text: str | None, owner: np.ndarray) -> np.ndarray:
    """The distinct slots of a text's n-grams. `owner` is scratch room of SLOTS places."""
    words = (text or "").lower().split()
    if not words:
        return np.empty(0, np.int32)
    codes = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), "<u4")
    step = BLOCK - GRAMS[-1] + 1
    blocks = [_block_slots(codes[i : i + BLOCK].astype(np.uint64), owner) for i in range(0, max(1, len(codes) - GRAMS[-1] + 1), step)]
    return blocks[0] if len(blocks) == 1 else np.unique(np.concatenate(blocks))


def ratios(texts: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """The naive Bayes log-count ratio of each slot; 0 for those in fewer than FEW texts."""
    counts = [np.zeros(SLOTS), np.zeros(SLOTS)]
    for slots, y in zip(texts, toxic, strict=True):
        counts[y][slots] += 1
    seen = counts[0] + counts[1] >= FEW
    clean, bad = (np.where(seen, c + SMOOTH, 0) for c in counts)
    found = np.zeros(SLOTS)
    if seen.any():
        found[seen] = np.log(bad[seen] / bad.sum()) - np.log(clean[seen] / clean.sum())
    return found


def _probability(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Detector:
    """The model: a weight for each slot, and the intercept."""

    def __init__(self, weights: np.ndarray | None, intercept: float):
        self.weights, self.intercept = weights, intercept
        self.owner = np.zeros(SLOTS, np.int32)

    def __reduce__(self):
        return Detector, (self.weights, self.intercept)

    def score(self, text: str | None) -> float:
        found = self.intercept
        if self.weights is not None:
            found += float(self.weights[slots_of(text, self.owner)].sum(dtype=np.float64))
        return round(float(_probability(np.float64(found))), 6)


def train(texts: list[str], toxic: list[int], share: float, seed: int = 0) -> Detector:
    """Fits the classifier. `share` is that of toxic texts where it is to be used."""
    share = min(max(share, 1e-6), 1 - 1e-6)
    truth = np.array(toxic, np.int64)
    both = 0 < truth.sum() < len(truth)
    if not both:
        return Detector(None, log(share / (1 - share)))
    owner = np.zeros(SLOTS, np.int32)
    held = [slots_of(t, owner) for t in texts]
    scale = ratios(held, truth)
    held = [h[scale[h] != 0] for h in held]
    weights, squares = np.zeros(SLOTS), np.full(SLOTS, 1e-6)
    sampled = truth.mean()
    intercept, intercept_squares = log(sampled / (1 - sampled)), 1e-6
    random = np.random.default_rng(seed)
    for _ in range(max(PASSES, -(-STEPS * STEP // len(held)))):
        order = random.permutation(len(held))
        for i in range(0, len(order), STEP):
            step = order[i : i + STEP]
            sizes = np.array([len(held[j]) for j in step])
            slots = np.concatenate([held[j] for j in step])
            text = np.repeat(np.arange(len(step)), sizes)
            x = np.bincount(text, weights[slots] * scale[slots], len(step)) + intercept
            missed = _probability(x) - truth[step]
            used, place = np.unique(slots, return_inverse=True)
            slope = np.bincount(place, missed[text], len(used)) * scale[used] / len(step) + DECAY * weights[used]
            squares[used] += slope**2
            weights[used] -= RATE * slope / np.sqrt(squares[used])
            slope = missed.mean()
            intercept_squares += slope**2
            intercept -= RATE * slope / np.sqrt(intercept_squares)
    intercept += log(share / (1 - share)) - log(sampled / (1 - sampled))
    return Detector((weights * scale).astype(np.float32), float(intercept))


def held_out(doc_id: Column) -> Column:
    """The quarter of the ids whose labels training never sees."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _within(texts: list[str], toxic: list[int]) -> tuple[list[str], list[int]]:
    """Whole texts, in their order, while there is room for them: the classes share CHARS evenly."""
    room, kept = [CHARS // 2, CHARS // 2], []
    for i, (text, y) in enumerate(zip(texts, toxic, strict=True)):
        if room[y] > 0:
            room[y] -= len(text)
            kept.append(i)
    return [texts[i] for i in kept], [toxic[i] for i in kept]


def _trained(share: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[str] = []
        toxic: list[int] = []
        for batch in batches:
            texts += [t or "" for t in batch.column("text").to_pylist()]
            toxic += batch.column("toxic").to_pylist()
        model = train(*_within(texts, toxic), share)
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(pickle.dumps(model))], pa.binary())], ["model"])

    return run


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", scratch: Scratch | None = None,
) -> Detector:
    """The classifier fitted on a sample of the labelled documents that are not held out.

    Labels meet the ids of documents first, without the texts. Each class's sampled rows are the ROWS ids with the least hashes; a bar on
    the hash leaves about twice as many to sort. Only their texts are read, beside ids of a bounded number. The model comes to the
    driver, and the two counts.
    """
    spark = docs.sparkSession
    ship_package(spark)
    scratch = scratch or Scratch(spark)
    given = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{toxic}`").cast("int").alias("toxic"))
    given = given.where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("id")))
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    given = given.groupBy("id").agg(F.max("toxic").alias("toxic")).join(rows.select("id").distinct(), "id", "left_semi")
    given = scratch.table(given, "labelled")
    counts = {r["toxic"]: r["rows"] for r in given.groupBy("toxic").agg(F.count(F.lit(1)).alias("rows")).collect()}
    if not counts:
        return Detector(None, -30.0)
    key = F.xxhash64(F.lit("toxic"), "id")
    draw = F.pmod(key, F.lit(1 << 30)) / F.lit(float(1 << 30))
    bar = F.when(F.col("toxic") == 1, F.lit(2 * ROWS / max(1, counts.get(1, 0)))).otherwise(F.lit(2 * ROWS / max(1, counts.get(0, 0))))
    drawn = given.withColumn("draw", draw).where(F.col("draw") < bar)
    in_turn = Window.partitionBy("toxic").orderBy("draw", "id")
    drawn = drawn.withColumn("turn", F.row_number().over(in_turn)).where(F.col("turn") <= ROWS)
    drawn = scratch.table(drawn.select("id", "toxic", "draw"), "drawn")
    # At most 2 * ROWS ids are broadcast. Of documents that share one, the text with the least hash is taken, picked before the shuffle.
    sample = rows.join(F.broadcast(drawn), "id").groupBy("id", "toxic", "draw").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    sample = scratch.table(sample, "sample").repartition(1).sortWithinPartitions("draw", "id").select("text", "toxic")
    share = counts.get(1, 0) / sum(counts.values())
    model = sample.mapInArrow(_trained(share), "model binary").first()
    return pickle.loads(zlib.decompress(model["model"]))


def _scored(model: Detector) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for b in batches for piece in pieces(b, "text", 1 << 20, BYTES)):
            scores = pa.array([model.score(t.as_py()) for t in batch.column("text")], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    return run


def score_toxicity(
    docs: DataFrame, labels: DataFrame | None = None, model: Detector | None = None, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic",
    least: float = TOXIC,
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 from a score of `least`). Give labels, or a fitted model."""
    ship_package(docs.sparkSession)
    model = model or fit(docs, labels, doc_id, text, toxic)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double"
    rows = rows.mapInArrow(_scored(model), schema)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))
