"""Benchmark decontamination by pigeonhole edit matching.

A test item may differ from its copy in a document by a budget of k edits, a share of its length. Cut into k + 1 pieces,
at least one piece of it occurs unchanged. All pieces are searched for at once in every document, and each hit is
verified: Myers' bit-parallel distance gives the least number of edits between the item and any passage around the hit.

Texts are compared in lower case, with one space for all that is neither letter nor digit. Items longer than PASSAGE are
cut into about equal passages, between words where a space is near and anywhere else, so also in scripts that write none. Each
has its share of the budget, and a document leaks an item if it holds any of them: a copy of the whole item within budget
has a passage within budget, and so has a long excerpt. Items of fewer than LEAST characters are one passage that is
searched without edits, from word bound to word bound; scripts that write no space between words need no bounds. Items of
fewer than LEAST_EXACT characters, which would be found by chance, are looked for as entire documents.

Scale: the benchmark is the query set, taken in blocks of a fixed number of characters; each block is one pass over the
documents, without a shuffle. Only a block goes through the driver.

Edge cases. Null and empty documents and items match nothing, nor do texts without a letter or digit. Item ids are of any type.
Very long documents are searched whole, in time that grows with their length. Repeated documents each have their matches;
repeated items match each under its id. An item that occurs several times in a document gives several rows, also back to back. Of matches that overlap, the one with the
fewest edits is reported, the first of such. Empty tables give no rows. Extra columns are left out by `find_leaks` and kept by
`drop_leaks`.
"""

from __future__ import annotations

import re
from bisect import bisect_right, insort
from collections.abc import Callable, Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyshelf.llm.common import ship_package

# Documented parameters: edits per character of a passage, characters of a passage, and of a block of the benchmark.
BUDGET, PASSAGE, LEAST, BLOCK = 0.08, 120, 40, 400_000
# Documented parameter: characters of the shortest item that is searched within documents.
LEAST_EXACT = 3
# Letters of scripts that write no space between words: Thai to Tibetan, Burmese, Khmer, kana, Han.
UNSPACED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
APART = re.compile(r"[\W_]+")
Passage = tuple[object, int, str]


def normal(text: str) -> str:
    return APART.sub(" ", text).lower().strip()


def passages_of(text: str, most: int) -> list[str]:
    """The normal text in equal parts of about `most` characters at most, cut at a space if there is one near the bound."""
    whole = normal(text)
    parts, slack = -(-len(whole) // most), most // 8
    if not whole:
        return []
    bounds = [0]
    for i in range(1, parts):
        at = i * len(whole) // parts
        after, before = whole.find(" ", at, at + slack), whole.rfind(" ", at - slack, at)
        bounds.append(after if after >= 0 else before if before >= 0 else at)
    return [whole[start:end].strip() for start, end in zip(bounds, [*bounds[1:], len(whole)], strict=True)]


def cuts_of(length: int, edits: int) -> list[int]:
    """Bounds of edits + 1 pieces of nearly equal length."""
    return [j * length // (edits + 1) for j in range(edits + 2)]


def distances(pattern: str, text: str, anchored: bool = False) -> list[int]:
    """For each character of the text, the least distance between the pattern and any substring that ends with it.

    If anchored, substrings start where the text does. Myers' recurrence on one long bit vector: bit i tells how the
    column of distances changes at row i.
    """
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    bits: dict[str, int] = {}
    for i, c in enumerate(pattern):
        bits[c] = bits.get(c, 0) | 1 << i
    up, down, score, carry = full, 0, m, int(anchored)
    scores = []
    for c in text:
        equal = bits.get(c, 0)
        vertical = equal | down
        same = (((equal & up) + up) ^ up) | equal
        plus = down | (full & ~(same | up))
        minus = up & same
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        # No carry into the first row unless anchored: a match may start anywhere.
        plus, minus = (plus << 1 | carry) & full, minus << 1 & full
        up = minus | (full & ~(vertical | plus))
        down = plus & vertical
        scores.append(score)
    return scores


def least_edits(pattern: str, text: str) -> tuple[int, int]:
    """The least distance between the pattern and any substring of the text, and where the first such one ends."""
    scores = distances(pattern, text)
    best = min(scores, default=len(pattern))
    return (best, scores.index(best) + 1) if best < len(pattern) else (len(pattern), 0)


def occurrences(pattern: str, text: str, edits: int) -> list[tuple[int, int, int]]:
    """(distance, start, end) of the substrings within so many edits; of those that overlap the best, the first of such."""
    # Every end counts, not only the lowest: within copies of a repeating pattern the distance doesn't change.
    ends = sorted((d, at) for at, d in enumerate(distances(pattern, text), 1) if d <= edits)
    starts: list[int] = []
    found: dict[int, tuple[int, int]] = {}

    def free(start: int, end: int) -> bool:
        i = bisect_right(starts, start)
        return (not i or found[starts[i - 1]][1] <= start) and (i == len(starts) or end <= starts[i])

    for distance, end in ends:
        # A match has at least this length.
        if not free(end - max(1, len(pattern) - distance), end):
            continue
        # The start is the end of the best match of the reversed texts.
        back = distances(pattern[::-1], text[max(0, end - len(pattern) - edits) : end][::-1], anchored=True)
        start = end - 1 - back.index(min(back))
        if free(start, end):
            insort(starts, start)
            found[start] = distance, end
    return [(found[at][0], at, found[at][1]) for at in starts]


class Finder:
    """Finds the leaks of a block of passages in one text."""

    def __init__(self, passages: list[Passage], budget: float):
        self.entire: dict[str, list[tuple[object, int]]] = {}
        for item, number, body in passages:
            if len(body) < LEAST_EXACT:
                self.entire.setdefault(body, []).append((item, number))
        self.passages = [
            (item, number, body, int(len(body) * budget) if len(body) >= LEAST else 0) for item, number, body in passages if len(body) >= LEAST_EXACT]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for p, (_, _, body, edits) in enumerate(self.passages):
            cuts = cuts_of(len(body), edits)
            for start, end in zip(cuts, cuts[1:], strict=False):
                pieces.setdefault(body[start:end], []).append((p, end))
        self.pieces = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.pieces.add_word(piece, places)
        self.pieces.make_automaton()

    def windows(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(passage, start, end) of the places where a passage may be, those that overlap as one."""
        hits: dict[int, list[int]] = {}
        # An automaton of nothing can't be searched.
        if not self.passages:
            return
        for last, places in self.pieces.iter(text):
            for p, end in places:
                hits.setdefault(p, []).append(last + 1 - end)
        for p, starts in hits.items():
            _, _, body, edits = self.passages[p]
            if len(body) < LEAST:
                yield from ((p, at, at + len(body)) for at in self.whole_words(body, text, starts))
                continue
            start = end = None
            for at in sorted(starts):
                if end is not None and at - edits <= end:
                    end = max(end, at + len(body) + edits)
                    continue
                if end is not None:
                    yield p, max(0, start), end
                start, end = at - edits, at + len(body) + edits
            yield p, max(0, start), end

    @staticmethod
    def whole_words(body: str, text: str, starts: list[int]) -> Iterator[int]:
        """The starts of a short item that are not inside of longer words, the first of those that overlap."""
        end = 0
        for at in sorted(starts):
            after = at + len(body)
            inside = at and text[at - 1] != " " and not UNSPACED.match(body[0])
            inside = inside or after < len(text) and text[after] != " " and not UNSPACED.match(body[-1])
            if at >= end and not inside:
                end = after
                yield at

    def matches(self, text: str | None) -> list[tuple[object, int, int, int, int]]:
        """(item, passage number, edits, start, end) of each leak; start and end are code points of the text."""
        if not text:
            return []
        plain, found, places, breaks = normal(text), [], None, None
        for item, number in self.entire.get(plain, ()):
            places = [m.span() for m in re.finditer(r"[^\W_]+", text)]
            breaks = [i for i, c in enumerate(plain) if c == " "]
            found.append((item, number, 0, places[0][0], places[-1][1]))
        for p, start, end in self.windows(plain):
            item, number, body, edits = self.passages[p]
            near = occurrences(body, plain[start:end], edits) if len(body) >= LEAST else [(0, 0, end - start)]
            if near and places is None:
                places = [m.span() for m in re.finditer(r"[^\W_]+", text)]
                breaks = [i for i, c in enumerate(plain) if c == " "]
            for distance, begin, stop in near:
                first = bisect_right(breaks, start + begin)
                last = min(bisect_right(breaks, max(0, start + stop - 1)), len(places) - 1)
                found.append((item, number, distance, places[min(first, last)][0], places[last][1]))
        return sorted(found, key=lambda x: (x[3], str(x[0]), x[1]))


def _blocks(benchmark: DataFrame, item_id: str, text: str, block: int) -> Iterator[list[Passage]]:
    """Passages of the benchmark, a block at a time. Items are streamed to the driver, one partition after the other."""
    rows = benchmark.select(F.col(f"`{item_id}`"), F.col(f"`{text}`")).toLocalIterator()
    passages: list[Passage] = []
    size = 0
    for item, body in rows:
        for number, passage in enumerate(passages_of(body or "", PASSAGE)):
            passages.append((item, number, passage))
            size += len(passage)
            if size >= block:
                yield passages
                passages, size = [], 0
    if passages:
        yield passages


def _leaks(passages: list[Passage], budget: float, item_type: pa.DataType) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(passages, budget)
        for batch in batches:
            rows, columns = [], [[] for _ in range(5)]
            for i, text in enumerate(batch.column("text")):
                for match in finder.matches(text.as_py()):
                    rows.append(i)
                    for column, value in zip(columns, match, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(columns[0], item_type)] + [pa.array(c, pa.int64()) for c in columns[1:]],
                ["doc_id", "item_id", "passage", "edits", "start", "end"],
            )

    return run


def _clean(passages: list[Passage], budget: float, text: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(passages, budget)
        for batch in batches:
            yield batch.filter(pa.array([not finder.matches(t.as_py()) for t in batch.column(text)], pa.bool_()))

    return run


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", budget: float = BUDGET, block: int = BLOCK,
) -> DataFrame:
    """One row per leak: doc_id, item_id, passage, edits, start, end."""
    spark = docs.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = benchmark.schema[item_id].dataType
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {kind.simpleString()}, passage long, edits long, start long, end long"
    found = [docs.mapInArrow(_leaks(p, budget, to_arrow_type(kind)), schema) for p in _blocks(benchmark, item_id, item_text, block)]
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], schema)


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    budget: float = BUDGET, block: int = BLOCK,
) -> DataFrame:
    """The documents that hold no test item, all columns; each block of the benchmark is a pass without a shuffle."""
    spark = docs.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    for passages in _blocks(benchmark, item_id, item_text, block):
        docs = docs.mapInArrow(_clean(passages, budget, text), docs.schema)
    return docs
