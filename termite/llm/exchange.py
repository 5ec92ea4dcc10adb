"""Counting the keys of a whole corpus and sending the counts back.

Documents are dealt into chunks of a few MB by a hash of their id.  A chunk
reduces its keys (64-bit hashes of windows or shingles) to the distinct ones and
sends them, packed, to *buckets* by their leading bits; a bucket adds up what all
chunks sent and answers each chunk with one byte a key: the count over the
corpus, 255 standing for all larger ones.  A chunk's distinct keys are sorted, so
the answers of its buckets, joined in order, line up with them.

A key that occurs everywhere is sent once a chunk, so no bucket is hot.  The
text moves once: both uses of the chunks read the same exchange.  Sizes follow
the corpus, measured first: chunks by its bytes, buckets by its words."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = "__chunk"
MOST = 255
Keys = Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]


def in_chunks(docs: DataFrame, chunk_bytes: int = 4 << 20) -> tuple[DataFrame, int]:
    """``docs`` with a chunk number, and the bytes of all texts.  At least 16
    chunks, so that a small corpus still runs on several cores."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(16, math.ceil(size / chunk_bytes))
    return docs.withColumn(CHUNK, F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(n))), size


def bucket_bits(size: int, keys_a_bucket: int = 1 << 19) -> int:
    """Leading bits that name a bucket, from the corpus bytes (a word takes
    about six), between 6 and 24."""
    return min(24, max(6, math.ceil(math.log2(max(1, size / 6 / keys_a_bucket)))))


def pack(keys: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.reshape(-1).view("<u8")


def corpus_counts(chunks: DataFrame, keys_of: Keys, bits: int, width: int = 8) -> DataFrame:
    """``(__chunk, bucket, counts)``: for each chunk and bucket, one byte a
    distinct key of the chunk.  ``keys_of(table)`` gives the sorted distinct keys
    and their counts there.  ``width``: the low bytes of a key that are sent; the
    bucket implies the leading bits, so 7 bytes lose nothing from 8 bits on."""
    width = 8 if width == 7 and bits < 8 else width
    shift = np.uint64(64 - bits)

    def send(table: pa.Table) -> pa.Table:
        keys, counts = keys_of(table)
        chunk = table.column(CHUNK)[0].as_py()
        bucket = (keys >> shift).astype(np.int64)
        names, first = np.unique(bucket, return_index=True)
        ends = np.append(first[1:], len(keys))
        small = np.minimum(counts, MOST).astype(np.uint8)
        return pa.table({
            "bucket": pa.array(names.astype(np.int32), pa.int32()),
            CHUNK: pa.array([chunk] * len(names), pa.int64()),
            "keys": pa.array([pack(keys[a:b], width) for a, b in zip(first, ends)], pa.binary()),
            "counts": pa.array([small[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        parts = [unpack(x, width) for x in table.column("keys").to_pylist()]
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint8)
        distinct, at = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(at, weights=counts, minlength=len(distinct))
        answer = np.minimum(total, MOST).astype(np.uint8)[at]
        ends = np.cumsum([len(p) for p in parts])
        return pa.table({
            CHUNK: table.column(CHUNK), "bucket": table.column("bucket"),
            "counts": pa.array([x.tobytes() for x in np.split(answer, ends[:-1])], pa.binary())})

    sent = chunks.groupBy(CHUNK).applyInArrow(send, f"bucket int, {CHUNK} long, keys binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(add, f"{CHUNK} long, bucket int, counts binary")


def with_counts(chunks: DataFrame, counts: DataFrame, work: Callable[[pa.Table, np.ndarray], pa.Table],
                schema: str) -> DataFrame:
    """``work(table, counts)`` for each chunk; counts as ``keys_of`` orders them."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(answers.column("bucket").to_numpy(), kind="stable")
        parts = answers.column("counts").to_pylist()
        return work(table, np.frombuffer(b"".join(parts[i] for i in order), np.uint8))

    return chunks.groupBy(CHUNK).cogroup(counts.groupBy(CHUNK)).applyInArrow(run, schema)

