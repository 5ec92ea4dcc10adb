"""Removal of passages that occur more than once in a corpus.

Every window of ``window`` consecutive words gets a Rabin-Karp hash; Spark
counts the hashes over the corpus (:mod:`termite.llm.exchange`); the windows
whose hash occurs again merge into maximal intervals of words, which are cut.

Windows are judged on the input: the first occurrence goes like all others.  A
window's identity is its 64-bit hash over 64-bit word hashes; two different
windows meet with probability 2**-64 a pair (0.001 such pairs expected in 10**8
windows)."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from termite.llm import exchange as X
from termite.llm import words as W

WINDOW = 35
WORD = re.compile(rb"[^ \t\n\x0b\x0c\r]+")


def _windows(table: pa.Table, width: int):
    texts = W.texts_as_bytes(table.column("text"))
    words, offsets = W.split_all(texts)
    starts = np.flatnonzero(W.window_starts(offsets, width))
    return texts, words, offsets, starts, W.window_hashes(W.hash_words(words), width)[starts]


def without_removed(text: bytes, removed: np.ndarray) -> bytes:
    """``text`` less the removed words; each kept run stays as written, and runs
    are joined by a space."""
    if not removed.any():
        return text
    spans = [m.span() for m in WORD.finditer(text)]
    edge = np.flatnonzero(np.diff(np.concatenate(([1], removed.astype(np.int8), [1]))))
    return b" ".join(text[spans[a][0]:spans[b - 1][1]] for a, b in zip(edge[::2], edge[1::2]))


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = True,
                   chunk_bytes: int = 4 << 20) -> DataFrame:
    """``docs`` (any columns, ``doc_id`` and ``text`` among them) with
    ``n_words``, ``n_removed`` and ``kept_sha256`` (hex SHA-256 of the kept words
    joined by one space) added, which replace input columns of these names.  With
    ``with_text`` the text is the remaining text, else the column is left out.

    A null or empty text has no words and stays as it is, as does a text of fewer
    than ``window`` words.  Rows are documents: a repeated row repeats its
    windows.  An empty table gives an empty result."""
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
             T.StructField("kept_sha256", T.StringType())]
    docs = docs.drop(*[f.name for f in added])
    chunks, size = X.in_chunks(docs, chunk_bytes)
    keep = [f for f in docs.schema.fields if with_text or f.name != "text"]
    schema = T.StructType(keep + added)

    def keys_of(table: pa.Table):
        *_, hashes = _windows(table, window)
        return np.unique(hashes, return_counts=True)

    def cut(table: pa.Table, counts: np.ndarray) -> pa.Table:
        texts, words, offsets, starts, hashes = _windows(table, window)
        again = counts[np.unique(hashes, return_inverse=True)[1]] > 1
        gone = W.covered(starts[again], window, len(words))
        n_removed, digests, left = [], [], []
        nulls = table.column("text").is_null().to_pylist()
        for i, text in enumerate(texts):
            a, b = offsets[i], offsets[i + 1]
            out = gone[a:b]
            kept = [w for w, x in zip(words[a:b], out) if not x] if out.any() else words[a:b]
            n_removed.append(int(out.sum()))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            if with_text:
                left.append(None if nulls[i] else without_removed(text, out).decode())
        table = table.drop_columns([X.CHUNK])
        at = table.column_names.index("text")
        table = table.set_column(at, "text", pa.array(left, pa.string())) if with_text else table.drop_columns(["text"])
        for name, value in (("n_words", pa.array(np.diff(offsets), pa.int64())),
                            ("n_removed", pa.array(n_removed, pa.int64())),
                            ("kept_sha256", pa.array(digests, pa.string()))):
            table = table.append_column(name, value)
        return table

    counts = X.corpus_counts(chunks, keys_of, max(8, X.bucket_bits(size)), width=7)
    return X.with_counts(chunks, counts, cut, schema)
