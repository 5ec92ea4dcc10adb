"""Periodic runs of words in each document, by a dictionary of basic factors.

The dictionary names, for each power of two, the factors (stretches of words) of
that length: equal factors of a document share a name, and a factor twice as
long is named by the pair of its halves.  Where a factor of ``2**k`` words and
its next occurrence lie within a stretch of twice that length, they are at most
``2**k`` words apart and their distance is a period of that stretch; such
occurrences follow each other in arithmetic progressions.  Every distance is
taken at the one level where ``2**(k - 1) < distance <= 2**k``, so that a run is
proposed once; proposals of one distance at neighbouring places extend each
other to the whole run.  Within a run the next occurrence is exactly one smallest
period away, so no proposal has a smaller one, and a run ends where its
proposals end.

Only factors that occur again are named further.  Documents are judged one by
one, in place: no exchange."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from termite.llm import words as W

MIN_LENGTH = 6
MIN_EXPONENT = 4
BLOCK_BYTES = 1 << 20  # text handled at a time; a longer text is a block of its own

RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                    T.StructField("period", T.LongType())])
ADDED = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
                      T.StructField("collapsed", T.StringType())])


def _merged(start: np.ndarray, distance: np.ndarray, size: int) -> np.ndarray:
    """Runs (start, length, period) of the proposals: factors of ``size`` words at
    ``start`` that occur again ``distance`` words on."""
    order = np.lexsort((start, distance))
    start, distance = start[order], distance[order]
    first = np.ones(len(start), bool)
    first[1:] = (distance[1:] != distance[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(start)) - 1
    return np.stack((start[at], start[last] - start[at] + distance[at] + size, distance[at]), 1)


def runs(ids: np.ndarray, offsets: np.ndarray, min_length: int = MIN_LENGTH,
         min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """``(start, length, period)`` of the runs of all documents, by start, then
    period.  ``ids`` are the joined words of the documents that begin at
    ``offsets``; starts count from the first of all words.  ``min_exponent`` is 3
    or more: shorter runs need not show at the level of their period."""
    if min_exponent < 3:
        raise ValueError("min_exponent must be 3 or more")
    n = len(ids)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    end = np.repeat(offsets[1:], np.diff(offsets))
    place = np.lexsort((ids, doc))  # equal factors side by side, in the order of the text
    first = np.ones(n, bool)
    first[1:] = (ids[place][1:] != ids[place][:-1]) | (doc[place][1:] != doc[place][:-1])
    name = np.empty(n, np.int64)
    name[place] = np.maximum.accumulate(np.where(first, np.arange(n), 0)) if n else 0
    found, size = [], 1
    while len(place):
        distance = place[1:] - place[:-1]
        near = np.flatnonzero(~first[1:] & (2 * distance > size) & (distance <= size))
        if len(near):
            proposed = _merged(place[near], distance[near], size)
            found.append(proposed[proposed[:, 1] >= np.maximum(min_length, min_exponent * proposed[:, 2])])
        again = ~first
        again[:-1] |= ~first[1:]
        place = place[again]
        place = place[place + 2 * size <= end[place]]
        whole, half = name[place], name[place + size]
        by = np.lexsort((place, half, whole))
        place, whole, half = place[by], whole[by], half[by]
        group = np.ones(len(place), bool)
        group[1:] = whole[1:] != whole[:-1]
        first = group.copy()
        first[1:] |= half[1:] != half[:-1]
        # A name is its first slot; those that split up share the slots of their old name.
        slot = np.arange(len(place))
        begin = np.maximum.accumulate(np.where(group, slot, 0)) if len(place) else slot
        name[place] = whole + np.maximum.accumulate(np.where(first, slot, 0)) - begin if len(place) else 0
        size *= 2
    out = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def measure(texts: list[bytes], min_length: int, min_exponent: int) -> list[pa.Array]:
    """The columns of ``ADDED`` for each text."""
    words, offsets = W.split_all(texts)
    ids = np.unique(W.hash_words(words), return_inverse=True)[1]
    found = runs(ids, offsets, min_length, min_exponent)
    start, length, period = found.T
    gone = W.covered(start + period, length - period, len(words))
    at = np.searchsorted(start, offsets)
    local = start - np.repeat(offsets[:-1], np.diff(at))
    collapsed = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        out = gone[a:b]
        kept = [w for w, x in zip(words[a:b], out) if not x] if out.any() else words[a:b]
        collapsed.append(b" ".join(kept).decode())
    struct = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (local, length, period)], RUN.names)
    return [pa.array(np.diff(offsets), pa.int64()), pa.ListArray.from_arrays(pa.array(at, pa.int32()), struct),
            pa.array(collapsed, pa.string())]


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``docs`` (any columns, ``text`` among them) with the columns of ``ADDED``,
    which replace input columns of these names.

    ``runs``: by start, then period, the stretches of consecutive words (numbered
    from 0) with smallest period ``period`` and a length of at least
    ``min_length`` and ``min_exponent`` periods that no neighbouring word extends
    with this period.  ``collapsed``: the words that no run holds after its first
    period, joined by one space.  A null, empty or white-space text has no words,
    no runs and an empty ``collapsed``.  Each row is judged alone, so repeated
    rows get equal results and an empty table an empty one.  Words are compared
    by 64-bit hashes."""
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
                rows = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays(
                    rows.columns + measure(texts[begin:end], min_length, min_exponent), names=schema.names)
                begin = end

    return docs.mapInArrow(run, schema)
