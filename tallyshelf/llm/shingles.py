"""Word shingles as sets of 64-bit numbers, for whole texts, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Fixed value: A-Z to a-z, all other bytes as they are.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Documented parameter: bytes of a text that are hashed at once; longer texts go piece by piece.
PIECE = 1 << 20
# The published multipliers of a 64-bit finaliser.
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
# Fixed value: an odd base of the rolling polynomial.
BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit number over all bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


# One random number per byte value, from a rule.
VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse, modulo 2 ** 64, for i < n."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"], _powers["down"]


def _pieces(words: list[bytes], width: int) -> Iterator[list[bytes]]:
    """Runs of words of about PIECE bytes that overlap by width - 1 words."""
    start, size = 0, 0
    for i, w in enumerate(words):
        size += len(w) + 1
        if size >= PIECE and i + 1 - start >= 2 * width and i + 1 < len(words):
            yield words[start : i + 1]
            start = i + 2 - width
            size = sum(len(x) + 1 for x in words[start : i + 1])
    yield words[start:]


def words_of(text: str) -> list[bytes]:
    """Words of the text, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split()


def _hashes(words: list[bytes], width: int) -> np.ndarray:
    joined = np.frombuffer(b" ".join(words), np.uint8)
    up, down = powers(len(joined) + 1)
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(VALUES[joined] * up[: len(joined)], out=sums[1:])
    breaks = np.flatnonzero(joined == 32)
    starts = np.concatenate(([0], breaks + 1))
    ends = np.concatenate((breaks, [len(joined)]))
    k = min(width, len(words))
    starts, ends = starts[: len(starts) - k + 1], ends[k - 1 :]
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the shingles of `width` words; of all words at once, if there are fewer."""
    words = words_of(text or "")
    if not words:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        return np.unique(np.concatenate([_hashes(piece, width) for piece in _pieces(words, width)]))
