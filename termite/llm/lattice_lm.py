"""Language-model scores from the lattice of all subword segmentations.

The pieces and their first scores come from an existing tokenizer vocabulary.
The training documents' word counts, gathered from the whole corpus, re-estimate
the pieces' probabilities by their expected use over all segmentations (one step
of expectation and maximisation).  A text's probability is that of its words,
each the sum over its segmentations by the log-space forward recursion, and of
the end: no piece crosses a word's border, so a word's sum is computed once for
the whole corpus, where its counts meet.

Chunks of documents send their distinct words to buckets by hash; a bucket adds
up the training counts, scores each word, and answers the chunks."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termite.llm import exchange as X
from termite.llm import words as W
from termite.llm.lattice import Trie, build_trie, expected_counts, marginals

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
UNIT = 1 << 20       # expected counts are summed as integers of this part, so that reruns agree
BATCH_BYTES = 4 << 20
N_TOKENS, N_WORDS, N_DOCS = -1, -2, -3  # rows of statistics beside the pieces


@dataclass
class Vocabulary:
    pieces: list[bytes]
    log_p: np.ndarray


@dataclass
class Model:
    trie: Trie
    log_p: np.ndarray
    log_end: float
    train_tokens: int   # all training tokens, ends included
    train_types: int    # distinct ones, the end included
    train_docs: int


def read_vocabulary(path: str = VOCABULARY) -> Vocabulary:
    """Pieces of a sentencepiece model that can occur in a lower-cased word with a
    leading space, every byte among them.  The file's scores are negative merge
    ranks; a piece of rank r weighs 1 / (r + 10), a byte that is no piece as much
    as the last rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    weight: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        if piece != piece.lower() or any(c in b" \t\n\x0b\x0c\r" for c in piece[1:]):
            continue
        weight[piece] = max(weight.get(piece, 0.0), 1 / (10 - model.get_score(i)))
    least = 1 / (10 + model.get_piece_size())
    for b in range(256):
        weight.setdefault(bytes([b]), least)
    pieces = sorted(weight)
    p = np.array([weight[x] for x in pieces])
    return Vocabulary(pieces, np.log(p / p.sum()))


def _with_split(docs: DataFrame) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    return docs.select("doc_id", "text", held.alias("held_out"))


def _distinct(words: list[bytes], trains: np.ndarray | None = None) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words in order of hash (then bytes), their hashes, and how often
    each stands at a place that ``trains``."""
    count = Counter(words)
    trained = count if trains is None else Counter(w for w, x in zip(words, trains.tolist()) if x)
    names = list(count)
    hashes = W.hash_words(names)
    order = sorted(range(len(names)), key=names.__getitem__)
    order = np.array(order, np.int64)[np.argsort(hashes[order], kind="stable")] if names else np.zeros(0, np.int64)
    names = [names[i] for i in order]
    return names, hashes[order], np.array([trained[w] for w in names], np.uint32)


def _rows(names: list[bytes], hashes: np.ndarray, counts: np.ndarray, bits: int, chunk: int) -> pa.Table:
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    found, first = np.unique(bucket, return_index=True)
    ends = np.append(first[1:], len(names))
    return pa.table({
        "bucket": pa.array(found, pa.int32()), X.CHUNK: pa.array([chunk] * len(found), pa.int64()),
        "words": pa.array([b"\n".join(names[a:b]) for a, b in zip(first, ends)], pa.binary()),
        "counts": pa.array([counts[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())})


ROWS = f"bucket int, {X.CHUNK} long, words binary, counts binary"


def _merged(table: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray, list[int]]:
    """A bucket's distinct words, their counts over the corpus, the place of each
    sent word among them, and how many words each row sent."""
    parts = [x.split(b"\n") for x in table.column("words").to_pylist()]
    place: dict[bytes, int] = {}
    at = np.fromiter((place.setdefault(w, len(place)) for part in parts for w in part), np.int64, sum(map(len, parts)))
    counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint32)
    total = np.bincount(at, weights=counts, minlength=len(place)).astype(np.int64)
    return list(place), total, at, [len(p) for p in parts]


def train(docs: DataFrame, vocabulary: Vocabulary, size: int) -> Model:
    """A model of the documents that are not held out; ``size``: corpus bytes.
    The driver gets one number a vocabulary piece."""
    trie, log_p, bits = build_trie(vocabulary.pieces), vocabulary.log_p, X.bucket_bits(size)

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            texts = W.texts_as_bytes(pa.chunked_array([batch.column("text")]))
            begin = 0
            while begin < len(texts):
                end, size_ = begin, 0
                while end < len(texts) and (end == begin or size_ + len(texts[end]) <= BATCH_BYTES):
                    size_ += len(texts[end])
                    end += 1
                words, _ = W.split_all(texts[begin:end], lower=True)
                yield from _rows(*_distinct(words), bits, 0).to_batches()
                begin = end

    def estimate(table: pa.Table) -> pa.Table:
        words, total, *_ = _merged(table)
        use = np.rint(expected_counts(words, total, trie, log_p) * UNIT).astype(np.int64)
        some = np.flatnonzero(use)
        return pa.table({"piece": pa.array(np.concatenate((some, [N_TOKENS, N_WORDS])), pa.int64()),
                         "n": pa.array(np.concatenate((use[some], [total.sum(), len(words)])), pa.int64())})

    training = _with_split(docs).where("not held_out").select("text")
    rows = training.mapInArrow(count, ROWS).groupBy("bucket").applyInArrow(estimate, "piece long, n long")
    found = dict(map(tuple, rows.groupBy("piece").agg(F.sum("n")).collect()))
    n_docs = training.count()
    use = np.array([found.get(i, 0) / UNIT for i in range(len(log_p))])
    mass = use.sum() + n_docs + 0.5 * (len(use) + 1)
    return Model(trie, np.log((use + 0.5) / mass), math.log((n_docs + 0.5) / mass),
                 found.get(N_TOKENS, 0) + n_docs, found.get(N_WORDS, 0) + (n_docs > 0), n_docs)


def score(docs: DataFrame, vocabulary: Vocabulary | None = None, chunk_bytes: int = 4 << 20) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``
    for each row of ``docs(doc_id, text)``; other columns are not read.

    A null, empty or white-space text consists of its end only.  A document whose
    id is null is not held out.  Repeated rows score alike, and count each in
    training.  With no training documents every count is 0.  An empty table gives
    an empty result.  ``score`` is the log10 probability of the text as a sequence
    of words and an end; words are told apart as strings."""
    chunks, size = X.in_chunks(_with_split(docs), chunk_bytes)
    model = train(docs, vocabulary or read_vocabulary(), size)
    bits = X.bucket_bits(size)
    trie, log_p = model.trie, model.log_p
    floor = model.train_tokens + 0.5 * (model.train_types + 1)
    log_end, n_tokens, n_docs = model.log_end / math.log(10), model.train_tokens, model.train_docs

    def chunk_words(table: pa.Table):
        words, offsets = W.split_all(W.texts_as_bytes(table.column("text")), lower=True)
        trains = np.repeat(~table.column("held_out").to_numpy(zero_copy_only=False).astype(bool), np.diff(offsets))
        return words, offsets, _distinct(words, trains)

    def send(table: pa.Table) -> pa.Table:
        return _rows(*chunk_words(table)[2], bits, table.column(X.CHUNK)[0].as_py())

    def answer(table: pa.Table) -> pa.Table:
        words, total, at, lengths = _merged(table)
        log10 = marginals(words, trie, log_p) / math.log(10)
        cut = np.cumsum(lengths)[:-1]
        return pa.table({X.CHUNK: table.column(X.CHUNK), "bucket": table.column("bucket"),
                         "known": pa.array([x.tobytes() for x in np.split(total[at], cut)], pa.binary()),
                         "log10": pa.array([x.tobytes() for x in np.split(log10[at], cut)], pa.binary())})

    def add(table: pa.Table, answers: pa.Table) -> pa.Table:
        words, offsets, (names, *_) = chunk_words(table)
        order = np.argsort(answers.column("bucket").to_numpy(), kind="stable")
        known, log10 = (np.frombuffer(b"".join(parts[i] for i in order), kind) for parts, kind in (
            (answers.column("known").to_pylist(), np.int64), (answers.column("log10").to_pylist(), np.float64)))
        place = dict(zip(names, range(len(names))))
        at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        doc = np.repeat(np.arange(table.num_rows), np.diff(offsets))
        by_doc = lambda x: np.bincount(doc, weights=x, minlength=table.num_rows)
        return pa.table({
            "doc_id": table.column("doc_id"), "held_out": table.column("held_out"),
            "n_tokens": pa.array(np.diff(offsets) + 1, pa.int64()),
            "n_known": pa.array(by_doc((known > 0)[at]).astype(np.int64) + (n_docs > 0), pa.int64()),
            "train_tokens": pa.array([n_tokens] * table.num_rows, pa.int64()),
            "base_score": by_doc(np.log10((known + 0.5) / floor)[at]) + math.log10((n_docs + 0.5) / floor),
            "score": by_doc(log10[at]) + log_end})

    sent = chunks.groupBy(X.CHUNK).applyInArrow(send, ROWS)
    answers = sent.groupBy("bucket").applyInArrow(answer, f"{X.CHUNK} long, bucket int, known binary, log10 binary")
    kind = dict(docs.dtypes)["doc_id"]
    return chunks.groupBy(X.CHUNK).cogroup(answers.groupBy(X.CHUNK)).applyInArrow(
        add, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
             "base_score double, score double")
