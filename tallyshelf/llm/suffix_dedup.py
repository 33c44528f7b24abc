"""Removes passages that occur in an earlier document, by a distributed merge sort of suffixes.

Texts are UTF-8 bytes. A byte goes if a LENGTH-byte string that covers it also starts in a document with a smaller id.
Strings are judged on the input, overlaps count, and matches never cross documents.

Which suffixes are sorted. Of all windows of LENGTH bytes, equal ones pick the same place inside them: that of the least
hash of SEED bytes. So suffixes are taken at picked places only (about one byte in sixteen), and of these only the ones
whose first SEED bytes occur in two documents: hashes are exchanged as compressed sorted lists, and the places of those
that two documents have come back. Every repeated window holds such a place, so none is lost.

How they are sorted. Each task sorts its suffixes, keeps equal contexts once (with the least id; the others are answered on
the spot), and sends sorted runs to the part that their first bytes' hash names. A run is front-coded: a suffix is the
length of the prefix it shares with the one before, and the rest. In a part a loser tree merges the runs. Its nodes
keep the prefix a suffix shares with the last winner, so heads with different ones are ordered without looking at a
byte, and equal ones are compared from there on: known prefixes are never compared again. The merge gives the shared
prefix of neighbours, which tells for each offset of a window which suffixes have its bytes to the right of the place; a
hash of the bytes to the left finishes the groups, and each group's least id decides.

Scale: a part is a fixed amount of text (PART), so parts grow with the corpus; a task holds one part or one run.
Exact copies of a whole text leave after the first exchange, and a passage in very many documents is one
entry per run. Texts move twice, by document.

Edge cases. Null and empty texts have no bytes and nothing removed; texts shorter than LENGTH lose nothing. A null id is
larger than all ids. Rows with the same id are not smaller than each other: neither loses bytes to the other. Repeated
rows have equal results. An empty table gives no rows. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshelf.llm.common import ship_package, text_of
from tallyshelf.llm.shingles import BASE, VALUES, mix, powers
from tallyshelf.scratch import Scratch, shuffle_files_removed

# Fixed value of the task: bytes of a window. Documented parameters: bytes that are hashed, text of a part, of a piece.
LENGTH, SEED, PART, PIECE = 50, 20, 32 << 20, 4 << 20
# Documented parameters: places or suffixes that a task gathers before it sends them.
PLACES, SUFFIXES = 1 << 21, 1 << 18
# Hash bits that tell suffixes of a part apart, and the number that stands for a null id.
BITS, NO_ID = 40, (1 << 63) - 1


def _seed_hashes(data: np.ndarray, seed: int) -> np.ndarray:
    n = len(data) - seed + 1
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(VALUES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[seed:] - sums[:n]) * down[:n])


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """`pick` over all runs of `width` values, by doubling."""
    done = 1
    while 2 * done <= width:
        values = pick(values[:-done], values[done:])
        done *= 2
    return values if done == width else pick(values[: len(values) - (width - done)], values[width - done :])


def picked(data: np.ndarray, length: int = LENGTH, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Places of the least hash of each window, and these hashes, for a whole text, a piece at a time."""
    width = length - seed + 1
    places, hashes = [], []
    with np.errstate(over="ignore"):
        for start in range(0, len(data) - length + 1, PIECE):
            h = _seed_hashes(data[start : start + PIECE + length - 1], seed)
            least = np.zeros(len(h) + width - 1, np.uint64)
            least[width - 1 : len(h)] = _slide(h, width, np.minimum)
            at = np.flatnonzero(_slide(least, width, np.maximum) == h)
            places.append(at + start)
            hashes.append(h[at])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at, first = np.unique(np.concatenate(places), return_index=True)
    return at, np.concatenate(hashes)[first]


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob; bytes of equal rank stand together."""
    parts = [np.array([len(arrays)], np.int64).tobytes()]
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts.append(np.array([len(a), a.dtype.itemsize, ord(a.dtype.kind)], np.int64).tobytes())
        parts.append(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes())
    whole = b"".join(parts)
    return len(whole).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(whole, asbytes=True)


def _unpack(blob: bytes) -> list[np.ndarray]:
    size = int.from_bytes(blob[:8], "little")
    whole = pa.Codec("zstd").decompress(blob[8:], decompressed_size=size, asbytes=True)
    at, out = 8, []
    for _ in range(int(np.frombuffer(whole, np.int64, 1)[0])):
        n, width, kind = (int(x) for x in np.frombuffer(whole, np.int64, 3, at))
        at += 24
        planes = np.frombuffer(whole, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(np.dtype(f"{chr(kind)}{width}")).reshape(n))
        at += n * width
    return out


def _blobs(rows: list[tuple[int, bool, bytes]]) -> pa.RecordBatch:
    part, local, blob = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(local, pa.bool_()), pa.array(blob, pa.binary())], ["part", "local", "blob"])


BLOBS = "part int, local boolean, blob binary"


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _bytes(text: pa.Scalar) -> np.ndarray:
    return np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.empty(0, np.uint8)


def _send_places(parts: int, length: int, seed: int) -> Callable:
    """Hashes at the picked places, in sorted lists by part."""
    def flush(hashes: list, ids: list, places: list) -> pa.RecordBatch:
        h, doc, at = np.concatenate(hashes), np.concatenate(ids), np.concatenate(places)
        part = (h >> np.uint64(BITS)) % np.uint64(parts)
        low = h & np.uint64((1 << BITS) - 1)
        order = np.argsort((part << np.uint64(BITS)) | low, kind="stable")
        part, low, doc, at = part[order], low[order], doc[order], at[order]
        bounds = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
        rows = []
        for p in range(parts):
            a, b = bounds[p], bounds[p + 1]
            if a < b:
                names, number = np.unique(doc[a:b], return_inverse=True)
                steps = np.diff(low[a:b], prepend=np.uint64(0))
                rows.append((p, False, _pack(steps, np.diff(names, prepend=0), number.astype(np.uint32), at[a:b].astype(np.int64))))
        return _blobs(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ids, places, size = [], [], [], 0
        for batch in batches:
            for doc, text in zip(_ids(batch.column("id")), batch.column("text"), strict=True):
                at, h = picked(_bytes(text), length, seed)
                if len(at):
                    hashes.append(h)
                    ids.append(np.full(len(at), doc, np.int64))
                    places.append(at)
                    size += len(at)
                    if size >= PLACES:
                        yield flush(hashes, ids, places)
                        hashes, ids, places, size = [], [], [], 0
        if size:
            yield flush(hashes, ids, places)

    return run


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """Blobs part by part, those to be merged and those that only pass; the rows come sorted by part."""
    part, merge, through = None, [], []
    for batch in batches:
        for p, local, blob in zip(batch.column("part").to_pylist(), batch.column("local").to_pylist(), batch.column("blob").to_pylist(), strict=True):
            if p != part and part is not None:
                yield merge, through
                merge, through = [], []
            part = p
            (through if local else merge).append(blob)
    if part is not None:
        yield merge, through


def _lists(doc: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """Values of each document as lists; the rows come sorted by document."""
    starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.empty(0, np.int64)
    offsets = pa.array(np.append(starts, len(doc)).astype(np.int32))
    return doc[starts], [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int64())) for v in values]


def _to_buckets(buckets: int, doc: np.ndarray, *values: np.ndarray) -> pa.RecordBatch:
    """Values of documents as one blob per bucket, which the id alone decides."""
    with np.errstate(over="ignore"):
        bucket = (mix(doc.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((doc, bucket))
    bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = []
    for b in range(buckets):
        some = order[bounds[b] : bounds[b + 1]]
        if len(some):
            rows.append((b, False, _pack(doc[some], *(v[some] for v in values))))
    return _blobs(rows)


def _shared_places(buckets: int) -> Callable:
    """Of each part the places whose hash two documents have, sent to the documents' buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for merge, _ in _by_part(batches):
            lows, docs, places = [], [], []
            for blob in merge:
                steps, names, number, at = _unpack(blob)
                lows.append(np.cumsum(steps, dtype=np.uint64))
                docs.append(np.cumsum(names)[number])
                places.append(at)
            low, doc, at = np.concatenate(lows), np.concatenate(docs), np.concatenate(places)
            order = np.argsort(low, kind="stable")
            low, doc, at = low[order], doc[order], at[order]
            starts = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
            several = np.minimum.reduceat(doc, starts) < np.maximum.reduceat(doc, starts)
            keep = np.repeat(several, np.diff(np.append(starts, len(low))))
            yield _to_buckets(buckets, doc[keep], at[keep])

    return run


def _document_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document of a bucket with all its places."""
    for merge, _ in _by_part(batches):
        doc, at = (np.concatenate(x) for x in zip(*map(_unpack, merge), strict=True))
        order = np.lexsort((at, doc))
        names, (lists,) = _lists(doc[order], at[order])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), lists], ["id", "places"])


def _big_endian(matrix: np.ndarray) -> list[np.ndarray]:
    """Columns of 64-bit numbers that sort as the rows' bytes, most significant first."""
    wide = -matrix.shape[1] % 8
    padded = np.ascontiguousarray(np.pad(matrix, ((0, 0), (0, wide))))
    return list(padded.view(">u8").astype(np.uint64).T)


def _shared_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each pair of rows."""
    differs = a != b
    return np.where(differs.any(1), differs.argmax(1), a.shape[1])


def _send_runs(parts: int, length: int, seed: int) -> Callable:
    """Front-coded sorted runs of the suffixes at the shared places, with the bytes to their left."""
    left_most = length - seed

    def gather(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        padded = np.zeros(left_most + len(data) + length, np.uint8)
        padded[left_most : left_most + len(data)] = data
        right = padded[(places + left_most)[:, None] + np.arange(length)]
        left = padded[(places + left_most - 1)[:, None] - np.arange(left_most)]
        return right, left, np.minimum(length, len(data) - places), np.minimum(left_most, places)

    def flush(gathered: list) -> pa.RecordBatch:
        right, left, right_size, left_size, doc, text, at = (np.concatenate(x) for x in zip(*gathered, strict=True))
        with np.errstate(over="ignore"):
            h = np.zeros(len(right), np.uint64)
            for i in range(seed):
                h = mix(h * np.uint64(BASE) + right[:, i])
        part = (h % np.uint64(parts)).astype(np.int32)
        words = _big_endian(right) + [right_size] + _big_endian(left) + [left_size]
        order = np.lexsort((at, text, doc, *words[::-1], part))
        right, left, right_size, left_size, doc, text, at, part = (x[order] for x in (right, left, right_size, left_size, doc, text, at, part))
        prefix = np.zeros(len(right), np.int64)
        prefix[1:] = _shared_prefix(right[1:], right[:-1])
        same = (prefix == length) & (np.r_[-1, part[:-1]] == part) & (np.r_[-1, right_size[:-1]] == right_size)
        same[1:] &= (left[1:] == left[:-1]).all(1) & (left_size[1:] == left_size[:-1])
        group = np.cumsum(~same) - 1
        heads = np.flatnonzero(~same)
        # The first row of a context has its least id. What others have of it, that document has too.
        beaten = doc > doc[heads][group]
        rows = []
        if beaten.any():
            b = np.flatnonzero(beaten & (left_size + right_size >= length))
            rows.append((int(h[0] % np.uint64(parts)), True, _pack(doc[b], text[b], at[b] - left_size[b], at[b] + right_size[b])))
        own = ~beaten
        count = np.bincount(group[own], minlength=len(heads))
        own_at, own_text = at[own], text[own]
        own_end = np.cumsum(count)
        bounds = np.searchsorted(part[heads], np.arange(parts + 1))
        for p in range(parts):
            a, b = bounds[p], bounds[p + 1]
            if a == b:
                continue
            of = heads[a:b]
            shared = prefix[of].copy()
            shared[0] = 0
            tails = right[of][np.arange(length) >= shared[:, None]]
            c, d = own_end[a] - count[a], own_end[b - 1]
            rows.append((p, False, _pack(
                shared.astype(np.uint8), tails, right_size[of].astype(np.uint8), left[of].ravel(), left_size[of].astype(np.uint8),
                doc[of], count[a:b].astype(np.uint32), own_text[c:d], own_at[c:d],
            )))
        return _blobs(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0
        for batch in batches:
            for doc, text_hash, text, places in zip(
                _ids(batch.column("id")), batch.column("text_hash").to_numpy(), batch.column("text"), batch.column("places"), strict=True
            ):
                data, at = _bytes(text), np.sort(places.values.to_numpy().astype(np.int64))
                at = at[at <= len(data) - seed]
                for i in range(0, len(at), SUFFIXES):
                    some = at[i : i + SUFFIXES]
                    n = len(some)
                    gathered.append((*gather(data, some), np.full(n, doc, np.int64), np.full(n, text_hash, np.int64), some))
                    size += n
                    if size >= SUFFIXES:
                        yield flush(gathered)
                        gathered, size = [], 0
        if size:
            yield flush(gathered)

    return run


def merge_runs(runs: list[list[bytes]], prefixes: list[list[int]]) -> tuple[list[int], list[int], list[int]]:
    """Merges sorted runs with a loser tree: run and place of each suffix in order, and the prefix shared with the last.

    `prefixes` holds what each suffix shares with the one before it in its run. `known[r]` is what the head of run r
    shares with the last winner: the larger it is, the smaller the suffix, and only equal ones need a look at bytes.
    """
    leaves = 1
    while leaves < len(runs):
        leaves *= 2
    heads = [run[0] if run else None for run in runs] + [None] * (leaves - len(runs))
    known, place = [0] * leaves, [0] * leaves
    losers = [0] * leaves

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser then knows what it shares with the winner."""
        one, two = heads[a], heads[b]
        if two is None:
            return a, b
        if one is None:
            return b, a
        ka, kb = known[a], known[b]
        if ka != kb:
            return (a, b) if ka > kb else (b, a)
        if one == two:
            known[b] = len(one)
            return a, b
        at = ka
        while one[at] == two[at]:
            at += 1
        if one[at] < two[at]:
            known[b] = at
            return a, b
        known[a] = at
        return b, a

    winners = list(range(leaves))
    level = leaves // 2
    while level:
        pairs = [play(winners[2 * i], winners[2 * i + 1]) for i in range(level)]
        for i, (_, loser) in enumerate(pairs):
            losers[level + i] = loser
        winners = [w for w, _ in pairs]
        level //= 2
    winner = winners[0]
    run_of, place_of, shared = [], [], []
    while heads[winner] is not None:
        run_of.append(winner)
        place_of.append(place[winner])
        shared.append(known[winner])
        place[winner] += 1
        at = place[winner]
        if at < len(runs[winner]):
            heads[winner], known[winner] = runs[winner][at], prefixes[winner][at]
        else:
            heads[winner] = None
        node = (leaves + winner) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2
    return run_of, place_of, shared


def _front_decode(shared: np.ndarray, tails: np.ndarray, length: int) -> np.ndarray:
    """Rows of `length` bytes from what each shares with the one before, and the rests."""
    own = np.arange(length) >= shared[:, None]
    rows = np.zeros(own.shape, np.uint8)
    rows[own] = tails
    index = np.arange(len(shared))
    for c in range(length):
        rows[:, c] = rows[np.maximum.accumulate(np.where(own[:, c], index, 0)), c]
    return rows


def _covered(blobs: list[bytes], length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merges the runs of a part: id, text, first and last byte + 1 of what an earlier document has, around each place."""
    left_most = length - seed
    decoded = [_unpack(b) for b in blobs]
    items, prefixes, firsts = [], [], []
    for shared, tails, right_size, *_ in decoded:
        right = _front_decode(shared.astype(np.int64), tails, length)
        new = np.r_[True, shared[1:] < length]
        at = np.flatnonzero(new)
        raw = right[at].tobytes()
        items.append([raw[i : i + length] for i in range(0, len(raw), length)])
        # What lies between two distinct suffixes is equal to the first, so the second's prefix stands for both.
        prefixes.append(shared[at].astype(int).tolist())
        firsts.append(np.append(at, len(shared)))
    run_of, place_of, shared_item = (np.array(x) for x in merge_runs(items, prefixes))
    base = np.cumsum([0] + [len(d[0]) for d in decoded])
    offset = np.cumsum([0] + [len(f) for f in firsts])
    flat = np.concatenate(firsts)
    begin, end = flat[offset[run_of] + place_of], flat[offset[run_of] + place_of + 1]
    sizes = end - begin
    starts = np.cumsum(sizes) - sizes
    rows = np.repeat(base[run_of] + begin - starts, sizes) + np.arange(sizes.sum())
    shared = np.full(len(rows), length)
    shared[starts] = shared_item
    right_size = np.concatenate([d[2] for d in decoded])[rows].astype(np.int64)
    left = np.concatenate([d[3].reshape(-1, left_most) for d in decoded])[rows]
    left_size = np.concatenate([d[4] for d in decoded])[rows].astype(np.int64)
    doc = np.concatenate([d[5] for d in decoded])[rows]
    far, near = np.full(len(rows), -1), np.full(len(rows), length)
    with np.errstate(over="ignore"):
        left_hash = np.zeros(len(rows), np.uint64)
        for a in range(left_most + 1):
            if a:
                left_hash = mix(left_hash * np.uint64(BASE) + left[:, a - 1])
            # Windows that start `a` bytes before the place: the rest of their bytes is shared by neighbours in order.
            joined = shared >= length - a
            near_one = joined.copy()
            near_one[:-1] |= joined[1:]
            some = np.flatnonzero(near_one & (left_size >= a) & (right_size >= length - a))
            if not len(some):
                continue
            group = mix(np.cumsum(~joined).astype(np.uint64)[some] * np.uint64(BASE) + left_hash[some])
            order = np.argsort(group, kind="stable")
            ordered = group[order]
            begins = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
            ids = doc[some[order]]
            least = np.repeat(np.minimum.reduceat(ids, begins), np.diff(np.append(begins, len(ids))))
            beaten = some[order[ids > least]]
            far[beaten] = a
            near[beaten] = np.minimum(near[beaten], a)
    hit = np.flatnonzero(far >= 0)
    count = np.concatenate([d[6] for d in decoded]).astype(np.int64)
    text, at = np.concatenate([d[7] for d in decoded]), np.concatenate([d[8] for d in decoded])
    row_start = np.cumsum(count) - count
    n = count[rows[hit]]
    each = np.repeat(row_start[rows[hit]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    places, texts = at[each], text[each]
    return np.repeat(doc[hit], n), texts, places - np.repeat(far[hit], n), places - np.repeat(near[hit], n) + length


def _spans(length: int, seed: int, buckets: int) -> Callable:
    """Covered spans of each part, sent to the documents' buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for merge, through in _by_part(batches):
            found = [tuple(_unpack(b)) for b in through]
            if merge:
                found.append(_covered(merge, length, seed))
            yield _to_buckets(buckets, *(np.concatenate(x) for x in zip(*found, strict=True)))

    return run


def _document_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text of a bucket with its covered spans; those that touch as one."""
    for merge, _ in _by_part(batches):
        doc, text, low, high = (np.concatenate(x) for x in zip(*map(_unpack, merge), strict=True))
        order = np.lexsort((low, text, doc))
        doc, text, low, high = doc[order], text[order], low[order], high[order]
        row = np.cumsum(np.r_[True, (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])]) - 1
        reach = np.maximum.accumulate(high + row * (1 << 40)) - row * (1 << 40)
        starts = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (low[1:] > reach[:-1])])
        ends = reach[np.append(starts[1:], len(low)) - 1]
        names, lists = _lists(row[starts], low[starts], ends)
        at = np.searchsorted(row, names)
        yield pa.RecordBatch.from_arrays([pa.array(doc[at], pa.int64()), pa.array(text[at], pa.int64()), *lists], ["id", "text_hash", "low", "high"])


def _cut(keep_text: bool) -> Callable:
    """What is left of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, digests, kept = [], [], [], [], []
            for text, copy, low, high in zip(batch.column("text"), batch.column("copy"), batch.column("low"), batch.column("high"), strict=True):
                data = bytes(text.as_buffer()) if text.is_valid else b""
                runs: list[list[int]] = [[0, len(data)]] if copy.as_py() and data else []
                if not runs and low.is_valid:
                    for a, b in sorted(zip(low.as_py(), high.as_py(), strict=True)):
                        if runs and a <= runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], b)
                        else:
                            runs.append([a, b])
                rest, at = [], 0
                for a, b in runs:
                    rest.append(data[at:a])
                    at = b
                rest = b"".join([*rest, data[at:]])
                sizes.append(len(data))
                removed.append(len(data) - len(rest))
                spans.append(len(runs))
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest if keep_text else None)
            columns = [pa.array(x, pa.int64()) for x in (sizes, removed, spans)] + [pa.array(digests, pa.string())]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns] + [pa.array(kept, pa.binary())] * keep_text, ["doc_id", *names] + ["kept"] * keep_text)

    return run


def _marks(docs: DataFrame, doc_id: str, text: str, length: int, seed: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The documents with id and text hash, and by these the spans to go, or that all goes: a written table."""
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(text_of(text)).alias("text_hash"), F.col(f"`{text}`").alias("text"),
    )
    # Whole copies of an earlier text: all of it goes, and it is no one's first occurrence.
    narrow = scratch.table(rows.select("id", "text_hash", F.unhex(F.md5(text_of("text").cast("binary"))).alias("digest"), F.octet_length(text_of("text")).alias("n")), "narrow")
    first = narrow.groupBy("digest").agg(F.min("id").alias("first"))
    marked = narrow.where(F.col("n") >= length).join(first, "digest")
    copies = marked.where("id > first").select("id", "text_hash").distinct()
    firsts = marked.where("id = first").select("id", "text_hash").distinct()
    parts = max(1, -(-(narrow.agg(F.sum("n")).first()[0] or 0) // PART))

    def by_part(blobs: DataFrame) -> DataFrame:
        # A task for each part: hashed, some tasks would get several parts and others none.
        return blobs.repartitionById(parts, "part").sortWithinPartitions("part")

    sent = rows.select("id", "text").mapInArrow(_send_places(parts, length, seed), BLOBS)
    shared = by_part(sent).mapInArrow(_shared_places(parts), BLOBS)
    places = scratch.table(by_part(shared).mapInArrow(_document_places, "id long, places array<long>"), "places")
    texts = rows.select("id", "text_hash", "text").join(firsts.join(places, "id"), ["id", "text_hash"])
    runs = texts.select("id", "text_hash", "text", "places").mapInArrow(_send_runs(parts, length, seed), BLOBS)
    spans = by_part(by_part(runs).mapInArrow(_spans(length, seed, parts), BLOBS))
    spans = spans.mapInArrow(_document_spans, "id long, text_hash long, low array<long>, high array<long>")
    nothing = F.lit(None).cast("array<long>")
    marks = spans.withColumn("copy", F.lit(False)).unionByName(copies.select("id", "text_hash", nothing.alias("low"), nothing.alias("high"), F.lit(True).alias("copy")))
    marks = scratch.table(marks, "marks")
    return rows, marks


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED, keep_text: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with `keep_text`, the bytes left as `kept`."""
    spark = docs.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    with shuffle_files_removed(spark):
        rows, marks = _marks(docs, doc_id, text, length, seed, Scratch(spark))
    rows = rows.join(marks, ["id", "text_hash"], "left").select("doc_id", "text", F.coalesce("copy", F.lit(False)).alias("copy"), "low", "high")
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return rows.mapInArrow(_cut(keep_text), schema + ", kept binary" * keep_text)
