"""Quality rules on the repetition inside a document, by a suffix array.

The suffix array over a text's words gives the longest common prefix of
neighbouring suffixes, and so for every word the longest repeat that begins
there.  Repeats that no longer one contains are maximal; their spans are united.
A document fails where the united spans cover too much of it or one repeat is
too long.  Documents are judged one by one, in place: no exchange."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from termite.llm import words as W

SYMBOLS = "#*$%&|<>"
BLOCK_BYTES = 1 << 20  # text handled at a time; a longer text is a block of its own

ADDED = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()), T.StructField("n_covered_words", T.LongType()),
    T.StructField("longest_repeat", T.LongType()), T.StructField("n_maximal_repeats", T.LongType()),
    T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])


def longest_repeats(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest run of words beginning there that
    begins elsewhere in the same document too.

    Prefix doubling over all documents at once: a rank is the first place of the
    suffixes that still look alike, and only those are sorted again.  ``seen``
    keeps the ranks by prefix length 1, 2, 4, ...; comparing neighbours from the
    longest prefix down gives their longest common prefix."""
    n = len(ids)
    out = np.zeros(n, np.int64)
    if n == 0:
        return out
    order = np.lexsort((ids, doc))
    fresh = np.ones(n, bool)
    fresh[1:] = (ids[order][1:] != ids[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    suffixes = order.copy()
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    seen, length = [rank], 1
    while True:
        alike = np.bincount(rank, minlength=n)[rank] > 1
        active = np.flatnonzero(alike)
        if len(active) == 0:
            break
        follow = active + length
        inside = follow < n
        inside[inside] = doc[follow[inside]] == doc[active[inside]]
        behind = np.where(inside, rank[np.minimum(follow, n - 1)] + 1, 0)
        by = np.argsort(rank[active] * (n + 1) + behind, kind="stable")
        active, behind = active[by], behind[by]
        group = rank[active]
        first = np.ones(len(active), bool)
        first[1:] = group[1:] != group[:-1]
        place = np.arange(len(active))
        slot = group + place - np.maximum.accumulate(np.where(first, place, 0))
        suffixes[slot] = active
        first[1:] |= behind[1:] != behind[:-1]
        rank = rank.copy()
        rank[active] = slot[np.maximum.accumulate(np.where(first, place, 0))]
        seen.append(rank)
        length *= 2
    a, b = suffixes[:-1], suffixes[1:]
    close = np.flatnonzero(seen[0][a] == seen[0][b])
    a, b = a[close], b[close]
    common = np.zeros(len(close), np.int64)
    for k in range(len(seen) - 1, -1, -1):
        i, j = a + common, b + common
        ok = (i < n) & (j < n)
        same = np.zeros(len(a), bool)
        same[ok] = seen[k][i[ok]] == seen[k][j[ok]]
        common += same.astype(np.int64) << k
    np.maximum.at(out, a, common)
    np.maximum.at(out, b, common)
    return out


def _per_document(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(W.ASCII_SPACE)]
    return len(lines) - len(set(lines))


def measure(texts: list[bytes], min_repeat: int, max_covered: int, max_repeat: int) -> dict[str, np.ndarray]:
    words, offsets = W.split_all(texts)
    n = np.diff(offsets)
    doc = np.repeat(np.arange(len(texts)), n)
    ids = np.unique(W.hash_words(words), return_inverse=True)[1]
    repeat = longest_repeats(ids, doc)
    eight = np.flatnonzero(repeat >= 8)
    begins = repeat >= min_repeat
    inner = np.zeros(len(repeat), bool)  # contained in the repeat that begins a word before
    inner[1:] = (doc[1:] == doc[:-1]) & (repeat[:-1] > repeat[1:])
    maximal = np.flatnonzero(begins & ~inner)
    strings = [t.decode() for t in texts]
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, doc, repeat)
    out = {
        "n_words": n,
        "word_chars": np.array([len(s) - sum(map(s.count, W.ASCII_SPACE)) for s in strings], np.int64),
        "n_symbols": np.array([sum(map(s.count, SYMBOLS)) for s in strings], np.int64),
        "n_dup_lines": np.array([_duplicate_lines(s) for s in strings], np.int64),
        "n_repeat_words": _per_document(W.covered(eight, 8, len(words)), offsets),
        "n_covered_words": _per_document(W.covered(maximal, repeat[maximal], len(words)), offsets),
        "longest_repeat": longest,
        "n_maximal_repeats": np.bincount(doc[maximal], minlength=len(texts)),
    }
    out["base_failed"] = (n < 20) | (100 * out["n_repeat_words"] > 30 * n)
    out["kept"] = ~out["base_failed"] & (100 * out["n_covered_words"] <= max_covered * n) & (longest <= max_repeat)
    return out


def quality(docs: DataFrame, min_repeat: int = 5, max_covered: int = 40, max_repeat: int = 100) -> DataFrame:
    """``docs`` with the columns of ``ADDED``, which replace input columns of
    these names.

    ``kept`` is false for a document with fewer than 20 words, with more than
    30 % of its words in 8-word windows that occur again in it, with more than
    ``max_covered`` % of its words in repeats of ``min_repeat`` words or more, or
    with a repeat of more than ``max_repeat`` words.  A null, empty or
    white-space text counts 0 everywhere and is not kept.  Each row is judged
    alone, so repeated rows get equal results and an empty table an empty one.
    Words are compared by 64-bit hashes; occurrences of a repeat may overlap."""
    docs = docs.drop(*ADDED.names)
    schema = T.StructType(docs.schema.fields + ADDED.fields)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            texts = W.texts_as_bytes(pa.chunked_array([batch.column("text")]))
            begin = 0
            while begin < len(texts):
                end, size = begin, 0
                while end < len(texts) and (end == begin or size + len(texts[end]) <= BLOCK_BYTES):
                    size += len(texts[end])
                    end += 1
                found = measure(texts[begin:end], min_repeat, max_covered, max_repeat)
                rows = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays(
                    rows.columns + [pa.array(found[f.name]) for f in ADDED], names=schema.names)
                begin = end

    return docs.mapInArrow(run, schema)
