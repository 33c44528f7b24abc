"""Language identification with a linear-chain conditional random field over words.

Every word is a position of a chain, and every 24 letters of a longer word are one; a chain is a line, or 64 positions of a
longer one. A word is letters and the marks on them, by Unicode category. A word's features are its prefixes
and suffixes, its n-grams, and its entry in a lexicon of frequent words of the training sample, all hashed; transitions
between languages are learned. Forward-backward gives each word's probabilities, so a text that switches languages has
its words labelled one by one. A document's language is the one with the largest mean probability, which is its score.

The field only chooses among the languages that it has learned, and its probabilities say little about a text of another, or
of a short one. Whether a text is of its language at all is told by its support: the share of its words' runs of four letters,
bounds included, that the training texts of the words' languages hold, so a text may switch languages. It doesn't depend
on the length of the text. It is compared
with the mean support of the training texts by the others of their language, so a language that is known from little,
or whose words seldom repeat, asks for less. Runs in fewer than one text in a hundred don't count, as labels may be wrong.

Training fits the field by AdaGrad on a bounded sample of labelled rows, whose words have the label of their document. It
runs in one task, as the sample is bounded (ROWS_PER_LANGUAGE, WORDS_PER_LANGUAGE). Every label is learned: beyond LANGUAGES labels,
each has fewer rows and words, so that the sample is no larger than for LANGUAGES, but a row of each label at least; beyond CELLS /
FEATURES labels features share fewer weights. Prediction is one pass over whole texts.

Edge cases. Null and empty texts, and texts without a letter, are `und` with score 0; so is everything if no row is
labelled. Ties go to the first language by code point. Repeated rows are predicted alike. A null id counts as empty text
where ids are split. An empty table gives no rows. Extra columns are left out by `identify` and kept by
`known_language`. A text without any supported run is never of a known language if support is asked for; one of a language learned from
a single text is if it has one such run. Very long texts are labelled whole, in chains. Superscripts, fractions and circled
digits are no letters, so a text of these alone is `und`.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyshelf.llm.common import pieces, ship_package
from tallyshelf.llm.shingles import mix
from tallyshelf.scratch import Scratch

# Documented parameters: the sample of a language, and the languages up to which it is whole; the lexicon, hashed features, words of
# a chain, code points of a word.
ROWS_PER_LANGUAGE, WORDS_PER_LANGUAGE, LANGUAGES = 250, 120_000, 64
LEXICON, FEATURES, CHAIN, LETTERS = 20_000, 1 << 17, 64, 24
# Documented parameters of training: passes over the sample, words of a step, its size, decay.
PASSES, STEP_WORDS, RATE, DECAY = 2, 4096, 0.2, 1e-4
# Documented parameters: weights, words whose scores a task keeps at a time, and documents it labels at a time; the last two are
# for up to LANGUAGES languages, and fewer for more. Bytes of text that a task labels at a time.
CELLS, REMEMBERED, TOGETHER, BYTES = 1 << 24, 400_000, 1000, 4_000_000
# Documented parameters: letters of a run that supports a language, least share of the training texts that hold it.
RUN, FEW_TEXTS = 4, 0.01
# A position of the chain: letters and their marks by Unicode category; digits of any kind are no letters.
TOKEN = regex.compile(rf"\p{{L}}[\p{{L}}\p{{M}}]{{0,{LETTERS - 1}}}|\n")
UNKNOWN = "und"


def shared(most: int, labels: int) -> int:
    """What is left for each label, or for each of anything that takes room by labels, of `most` for up to LANGUAGES of them."""
    return max(1, min(most, most * LANGUAGES // max(1, labels)))


def slots_of(labels: int) -> int:
    """Weights of a label: a power of two."""
    return min(FEATURES, 1 << (max(1, CELLS // max(1, labels)).bit_length() - 1))


def features_of(words: list[str], lexicon: frozenset[str], slots: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each word, word after word, and where each word's begin."""
    codes = np.array(words, f"<U{LETTERS}").view(np.uint32).reshape(len(words), LETTERS).astype(np.uint64)
    sizes = np.array([len(w) for w in words])
    ids, rows = [], []

    def add(kind: int, values: np.ndarray, which: np.ndarray) -> None:
        ids.append(mix(values * np.uint64(64) + np.uint64(kind)) % np.uint64(slots))
        rows.append(which)

    everyone = np.arange(len(words))
    with np.errstate(over="ignore"):
        base = np.uint64(1_000_003)
        for n in (1, 2, 3):
            grams = np.zeros((len(words), LETTERS - n + 1), np.uint64)
            for i in range(n):
                grams = grams * base + codes[:, i : LETTERS - n + 1 + i]
            for at in range(LETTERS - n + 1):
                which = everyone[sizes >= at + n]
                if not len(which):
                    break
                add(n, grams[which, at], which)
            has = everyone[sizes >= n]
            add(10 + n, grams[has, 0], has)
            add(20 + n, grams[has, sizes[has] - n], has)
        for n in (4, 5):
            has = everyone[sizes >= n]
            first, last = np.zeros(len(has), np.uint64), np.zeros(len(has), np.uint64)
            for i in range(n):
                first = first * base + codes[has, i]
                last = last * base + codes[has, sizes[has] - n + i]
            add(10 + n, first, has)
            add(20 + n, last, has)
        listed = np.array([i for i, w in enumerate(words) if w in lexicon], np.int64)
        whole = np.zeros(len(words), np.uint64)
        for i in range(LETTERS):
            whole = whole * base + codes[:, i]
        add(30, whole[listed], listed)
    rows, ids = np.concatenate(rows), np.concatenate(ids).astype(np.int64)
    order = np.argsort(rows, kind="stable")
    starts = np.searchsorted(rows[order], everyone)
    return ids[order], starts


def runs_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed runs of RUN letters of each word, word after word, and where each word's begin.

    A word's bounds are letters too. A word that is shorter than a run with them is one run.
    """
    codes = np.frombuffer(f" {' '.join(words)} {' ' * RUN}".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.array([len(w) for w in words], np.int64) + 2
    begins = np.concatenate(([0], np.cumsum(sizes - 1)[:-1])).astype(np.int64)
    many = np.maximum(1, sizes - RUN + 1)
    starts = np.concatenate(([0], np.cumsum(many)[:-1])).astype(np.int64)
    at = np.arange(many.sum()) - np.repeat(starts - begins, many)
    left = np.repeat(begins + sizes, many) - at
    runs = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(RUN):
            runs = runs * np.uint64(0x9E3779B97F4A7C15) + np.where(i < left, codes[at + i], 0).astype(np.uint64) + np.uint64(1)
    return mix(runs), starts


class Support:
    """The runs that the texts of each label hold, and the mean share that other texts of a label support."""

    def __init__(self, labels: int, vocabulary: list[str], texts: list[tuple[np.ndarray, int]]):
        runs, starts = runs_of(vocabulary)
        self.runs, own = np.unique(runs, return_inverse=True)
        ends = np.append(starts[1:], len(runs))
        self.expected = np.zeros(labels)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        by_label: list[dict[bytes, np.ndarray]] = [{} for _ in range(labels)]
        for words, label in texts:
            # Equal texts count once: copies would vouch for one another.
            by_label[label][words.tobytes()] = words
        for label, own_texts in enumerate(by_label):
            each = [own[_spans(starts[w], ends[w])] for w in own_texts.values()]
            if not each:
                continue
            held, texts_with = np.unique(np.concatenate([np.unique(e) for e in each]), return_counts=True)
            least = max(1, int(np.ceil(FEW_TEXTS * len(each))))
            others = np.zeros(len(self.runs), bool)
            others[held[texts_with > least]] = True
            self.expected[label] = np.mean([others[e].mean() for e in each])
            held = held[texts_with >= least]
            found.append((held, np.full(len(held), label)))
        held, label = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(held, kind="stable")
        self.labels = label[order].astype(np.int32)
        self.starts = np.searchsorted(held[order], np.arange(len(self.runs) + 1))

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each word, how many of its runs each label holds, and how many it has."""
        runs, starts = runs_of(words)
        sizes = np.diff(np.append(starts, len(runs)))
        at = np.minimum(np.searchsorted(self.runs, runs), len(self.runs) - 1)
        hit = self.runs[at] == runs
        word, at = np.repeat(np.arange(len(words)), sizes)[hit], at[hit]
        many = self.starts[at + 1] - self.starts[at]
        label = self.labels[_spans(self.starts[at], self.starts[at + 1])]
        counts = np.bincount(np.repeat(word, many) * len(self.expected) + label, minlength=len(words) * len(self.expected))
        return counts.reshape(len(words), -1).astype(np.float32), sizes


def _spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all spans, one after the other."""
    sizes = ends - starts
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


class Chains:
    """The chains of a token stream, longest first; `numbers` has the words' numbers, -1 for the end of a line."""

    def __init__(self, numbers: np.ndarray, most: int = CHAIN):
        word = numbers >= 0
        self.at = np.flatnonzero(word)
        self.words = numbers[self.at]
        line = np.cumsum(~word)[self.at]
        new_line = np.ones(len(line), bool)
        new_line[1:] = line[1:] != line[:-1]
        begins = np.flatnonzero(new_line)
        within = np.arange(len(line)) - np.repeat(begins, np.diff(np.append(begins, len(line))))
        starts = np.flatnonzero(within % most == 0)
        sizes = np.diff(np.append(starts, len(line)))
        order = np.argsort(-sizes, kind="stable")
        self.starts, self.sizes = starts[order], sizes[order]
        self.active = [int(np.searchsorted(-self.sizes, -t, side="left")) for t in range(int(self.sizes[0]) if len(starts) else 0)]


def forward_backward(chains: Chains, scores: np.ndarray, moves: np.ndarray, count: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the labels of each word, and if asked for the expected number of each move between labels."""
    labels = moves.shape[0]
    e = np.exp(scores - scores.max(1, keepdims=True)) if len(scores) else scores
    m = np.exp(moves - moves.max())
    ahead = np.empty_like(e)
    last = None
    for t, n in enumerate(chains.active):
        at = chains.starts[:n] + t
        a = e[at] if last is None else (last[:n] @ m) * e[at]
        a /= a.sum(1, keepdims=True)
        ahead[at] = a
        last = a
    out = np.empty_like(e)
    moved = np.zeros((labels, labels))
    behind = np.ones((len(chains.starts), labels))
    for t in range(len(chains.active) - 1, -1, -1):
        n = chains.active[t]
        at = chains.starts[:n] + t
        b = behind[:n]
        p = ahead[at] * b
        out[at] = p / p.sum(1, keepdims=True)
        if t:
            here = e[at] * b
            if count:
                before = ahead[at - 1]
                whole = ((before @ m) * here).sum(1, keepdims=True)
                moved += m * ((before / whole).T @ here)
            b = here @ m.T
            behind[:n] = b / b.sum(1, keepdims=True)
    return out, moved


class Field:
    """The model: weights of hashed features by label, weights of moves, the lexicon, the labels and their support."""

    def __init__(self, labels: list[str], lexicon: frozenset[str], weights: np.ndarray, moves: np.ndarray, support: Support | None = None):
        self.labels, self.lexicon, self.weights, self.moves, self.support = labels, lexicon, weights, moves, support
        self.forget()

    def __reduce__(self):
        return Field, (self.labels, self.lexicon, self.weights, self.moves, self.support)

    def forget(self) -> None:
        self.known: dict[str, int] = {"\n": -1}
        self.scores = np.empty((0, len(self.labels)))
        self.held, self.runs = np.empty((0, len(self.labels)), np.float32), np.empty(0, np.int64)

    def numbers(self, tokens: list[str]) -> np.ndarray:
        """Numbers of the words; the scores of new words are computed."""
        if len(self.known) > shared(REMEMBERED, len(self.labels)):
            self.forget()
        new = list(set(tokens).difference(self.known))
        if new:
            new.sort()
            ids, starts = features_of(new, self.lexicon, len(self.weights))
            first = len(self.scores)
            self.scores = np.concatenate([self.scores, np.add.reduceat(self.weights[ids], starts, axis=0)])
            self.known.update(zip(new, range(first, first + len(new)), strict=True))
        return np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))

    def label(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of the words among the tokens, their places there, and their numbers."""
        chains = Chains(self.numbers(tokens))
        return forward_backward(chains, self.scores[chains.words], self.moves)[0], chains.at, chains.words

    def supported(self, words: np.ndarray, p: np.ndarray) -> float:
        """The support of words, by their numbers and probabilities of labels: 1 is that of training texts."""
        if not self.support:
            return 0.0
        if len(self.known) - 1 > len(self.runs):
            # Once for the words of a batch: the walk passes all that are known.
            held, runs = self.support.of(list(islice(self.known, 1 + len(self.runs), None)))
            self.held, self.runs = np.concatenate([self.held, held]), np.concatenate([self.runs, runs])
        found = float((p * self.held[words]).sum())
        expected = float((p * self.support.expected).sum(1) @ self.runs[words])
        return round(found / expected, 6) if expected else float(found > 0)


def tokens_of(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def train(texts: list[tuple[str, str]], seed: int = 0) -> Field:
    """Fits the field on (text, label) pairs."""
    labels = sorted({label for _, label in texts})
    tokens: list[list[str]] = []
    wanted: list[int] = []
    room = dict.fromkeys(labels, shared(WORDS_PER_LANGUAGE, len(labels)))
    for text, label in texts:
        words = tokens_of(text)[: room[label]]
        room[label] -= len(words)
        if words:
            tokens.append(words)
            wanted.append(labels.index(label))
    counts = Counter(w for t in tokens for w in t if w != "\n")
    lexicon = frozenset(w for w, n in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:LEXICON] if n > 2)
    size, slots = len(labels), slots_of(len(labels))
    field = Field(labels, lexicon, np.zeros((slots, size)), np.zeros((size, size)))
    if not counts:
        return field
    vocabulary = sorted(counts)
    number = {w: i for i, w in enumerate(vocabulary)} | {"\n": -1}
    spoken = [(np.array([number[w] for w in t if w != "\n"], np.int64), y) for t, y in zip(tokens, wanted, strict=True)]
    field.support = Support(size, vocabulary, [(w, y) for w, y in spoken if len(w)])
    ids, starts = features_of(vocabulary, lexicon, slots)
    ends = np.append(starts[1:], len(ids))
    squares, move_squares = np.full((slots, size), 1e-6), np.full((size, size), 1e-6)
    random = np.random.default_rng(seed)
    # Steps of about STEP_WORDS words, from runs of CHAIN tokens of all documents in random order.
    runs = [(t[i : i + CHAIN], y) for t, y in zip(tokens, wanted, strict=True) for i in range(0, len(t), CHAIN)]
    per_step = shared(STEP_WORDS // CHAIN, size)
    for _ in range(PASSES):
        order = random.permutation(len(runs))
        for i in range(0, len(runs), per_step):
            stream, truth = [], []
            for j in order[i : i + per_step]:
                stream += [*(number[w] for w in runs[j][0]), -1]
                truth += [runs[j][1]] * (len(runs[j][0]) + 1)
            chains = Chains(np.array(stream))
            if not len(chains.words):
                continue
            words, places = np.unique(chains.words, return_inverse=True)
            spans = [np.arange(starts[w], ends[w]) for w in words]
            sizes = np.array([len(s) for s in spans])
            used = ids[np.concatenate(spans)]
            begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            scores = np.add.reduceat(field.weights[used], begins, axis=0)
            p, moved = forward_backward(chains, scores[places], field.moves, count=True)
            label = np.array(truth)[chains.at]
            p[np.arange(len(p)), label] -= 1
            by_word = np.stack([np.bincount(places, p[:, y], len(words)) for y in range(size)], 1)
            touched, slot = np.unique(used, return_inverse=True)
            spread = np.repeat(by_word, sizes, axis=0)
            slope = np.stack([np.bincount(slot, spread[:, y], len(touched)) for y in range(size)], 1) / len(p)
            slope += DECAY * field.weights[touched]
            squares[touched] += slope**2
            field.weights[touched] -= RATE * slope / np.sqrt(squares[touched])
            # All words of a document have its label, so every observed move stays at its label.
            stays = np.zeros((size, size))
            later = np.ones(len(p), bool)
            later[chains.starts] = False
            np.fill_diagonal(stays, np.bincount(label[later], minlength=size))
            slope = (moved - stays) / len(p) + DECAY * field.moves
            move_squares += slope**2
            field.moves -= RATE * slope / np.sqrt(move_squares)
    field.weights = field.weights.astype(np.float32)
    return field


def held_out(doc_id: Column) -> Column:
    """The fifth of the ids that training never sees."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts = [pair for b in batches for pair in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(pickle.dumps(train(texts)))], pa.binary())], ["model"])


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", scratch: Scratch | None = None) -> Field | None:
    """The field fitted on a sample of the labelled documents that are not held out; None if there are none.

    Each label's rows are those with the least hashes of their id and text, ROWS_PER_LANGUAGE of them, equal rows once; a bar on
    the hash leaves about twice as many to sort. Only the model comes to the driver, and the labels with their counts.
    """
    spark = docs.sparkSession
    ship_package(spark)
    scratch = scratch or Scratch(spark)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    key = F.xxhash64(F.lit("train"), "doc_id", "text")
    # Equal rows have one hash, and a bar by their number might leave none of them: different ones are counted.
    per_label = rows.groupBy("lang").agg(F.approx_count_distinct(key).alias("rows")).collect()
    if not per_label:
        return None
    most = shared(ROWS_PER_LANGUAGE, len(per_label))
    shares = spark.createDataFrame([(r["lang"], min(1.0, 2 * most / r["rows"])) for r in per_label], "lang string, share double")
    draw = F.pmod(key, F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.join(F.broadcast(shares), "lang").withColumn("draw", draw).where("draw < share").distinct()
    in_turn = Window.partitionBy("lang").orderBy("draw", "doc_id", "text")
    sample = sample.withColumn("turn", F.row_number().over(in_turn)).where(F.col("turn") <= most)
    sample = scratch.table(sample.select("doc_id", "text", "lang"), "sample")
    # Ordered, as the order of the rows decides where a label's words end and in which steps they come.
    ordered = sample.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "text")
    model = ordered.select("text", "lang").mapInArrow(_trained, "model binary").first()
    return pickle.loads(zlib.decompress(model["model"])) if model else None


def _predict(model: Field | None, runs: bool, support: bool = False) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = shared(TOGETHER, len(model.labels) if model else 1)
        for batch in (piece for b in batches for piece in pieces(b, "text", most, BYTES)):
            stream: list[str] = []
            ends, has = [], []
            for text in batch.column("text"):
                tokens = tokens_of(text.as_py()) if model else []
                has.append(any(t != "\n" for t in tokens))
                stream += tokens
                stream.append("\n")
                ends.append(len(stream))
            names, scores, found, supports = [], [], [], []
            p, at, words = model.label(stream) if model else (None, None, None)
            bounds = np.searchsorted(at, [0, *ends]) if model else None
            for i, ok in enumerate(has):
                if not ok:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    found.append([])
                    supports.append(0.0)
                    continue
                own = p[bounds[i] : bounds[i + 1]]
                mean = own.mean(0)
                best = int(mean.argmax())
                names.append(model.labels[best])
                # Rounded, as the last bits depend on which texts share a batch.
                scores.append(min(1.0, round(float(mean[best]), 6)))
                if support:
                    supports.append(model.supported(words[bounds[i] : bounds[i + 1]], own))
                if runs:
                    each = own.argmax(1)
                    cuts = np.concatenate(([0], np.flatnonzero(np.diff(each)) + 1, [len(each)]))
                    found.append([{"lang": model.labels[each[a]], "n_words": int(b - a)} for a, b in zip(cuts, cuts[1:], strict=False)])
            columns = [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            kind = pa.list_(pa.struct([("lang", pa.string()), ("n_words", pa.int64())]))
            more = {"runs": pa.array(found, kind)} if runs else {}
            more |= {"support": pa.array(supports, pa.float64())} if support else {}
            yield pa.RecordBatch.from_arrays(columns + list(more.values()), ["doc_id", "lang_pred", "score", *more])

    return run


def identify(
    docs: DataFrame, model: Field | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", runs: bool = False,
) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; with `runs`, the languages of its words in turn."""
    ship_package(docs.sparkSession)
    model = model or fit(docs, doc_id, text, lang)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    more = ", runs array<struct<lang: string, n_words: long>>" if runs else ""
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double{more}"
    rows = rows.mapInArrow(_predict(model, runs), schema)
    return rows.withColumn("held_out", held_out(F.col("doc_id")))


def known_language(
    docs: DataFrame, least: float = 0.5, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", support: float = 0.0,
) -> DataFrame:
    """The documents whose language is found with at least this score and support, all columns, in one pass without a shuffle.

    A support of 1 is what the language's training texts have; with 0, texts of languages that were never learned stay.
    """
    ship_package(docs.sparkSession)
    model = fit(docs, doc_id, text, lang)
    predict = _predict(model, False, support > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = pa.RecordBatch.from_arrays([batch.column(doc_id), batch.column(text)], ["doc_id", "text"])
            if not len(batch):
                continue
            found = pa.Table.from_batches(predict(iter([plain])))
            sure = [n != UNKNOWN and s >= least for n, s in zip(found.column("lang_pred").to_pylist(), found.column("score").to_pylist(), strict=True)]
            if support:
                sure = [ok and s >= support for ok, s in zip(sure, found.column("support").to_pylist(), strict=True)]
            yield batch.filter(pa.array(sure, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
