"""Words, word hashes and window hashes of whole texts (numpy, inside tasks).

A word is a maximal run of characters other than the six ASCII white-space
characters; ``bytes.split`` without an argument cuts UTF-8 exactly there, and
``bytes.lower`` lower-cases A-Z only."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

ASCII_SPACE = " \t\n\x0b\x0c\r"
# Base of the Rabin-Karp polynomial modulo 2**64: odd, so it has an inverse.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def texts_as_bytes(column: pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def split_all(texts: list[bytes], lower: bool = False) -> tuple[list[bytes], np.ndarray]:
    """The words of all texts in one list, and the offsets where each begins."""
    out: list[bytes] = []
    offsets = np.zeros(len(texts) + 1, np.int64)
    for i, t in enumerate(texts):
        out += (t.lower() if lower else t).split()
        offsets[i + 1] = len(out)
    return out, offsets


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit bijection that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of each ``width`` consecutive entries: the difference of
    two prefix sums of ``hash * BASE**i``, brought back to power 0."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    power = np.cumprod(np.full(n, BASE, np.uint64))
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * power, out=prefix[1:])
    back = np.cumprod(np.full(n - width + 1, BASE_INVERSE, np.uint64))
    return mix((prefix[width:] - prefix[:n - width + 1]) * back)


def window_starts(offsets: np.ndarray, width: int) -> np.ndarray:
    """Which of the ``n - width + 1`` windows over the joined words lie inside
    one text."""
    n = int(offsets[-1])
    inside = np.zeros(max(0, n - width + 1) + 1, np.int64)
    lengths = np.diff(offsets)
    long_enough = lengths >= width
    first = offsets[:-1][long_enough]
    np.add.at(inside, first, 1)
    np.add.at(inside, first + lengths[long_enough] - width + 1, -1)
    return np.cumsum(inside[:-1]) > 0


def covered(starts: np.ndarray, width: int | np.ndarray, n: int) -> np.ndarray:
    """Positions inside any interval ``[start, start + width)``."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + width, -1)
    return np.cumsum(step[:-1]) > 0
