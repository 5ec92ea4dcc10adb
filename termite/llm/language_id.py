"""Language identification by a bidirectional gated recurrent network on bytes.

The network is trained in numpy by backpropagation through time, on a bounded
sample of labelled text pieces.  It labels every byte of every text: texts are
cut into segments that are run side by side, forward and backward, and a
document's probabilities are the mean over its letters.  Gates and candidate
state are piecewise linear (clipped), which keeps a step to a few array
operations."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termite.llm import words as W
from termite.session import cut_lineage

HIDDEN = 8
SEGMENT = 128            # bytes that one run of the network reads
SIDE_BY_SIDE = 2048      # segments run together
DOCUMENTS_A_LANGUAGE = 400   # bound of the training sample
PIECES_A_DOCUMENT = 4
PIECE = 64               # bytes of a training piece
BROADCAST_BYTES = 8 << 20    # language names and counts that are sent to all tasks; more are joined by a shuffle
EPOCHS, BATCH, STEP = 8, 256, 0.01
# Which bytes count: letters and all bytes beyond ASCII.
COUNTS = np.array([chr(b).isalpha() or b > 127 for b in range(256)])


@dataclass
class Direction:
    x: np.ndarray   # 256 x 3H: what a byte adds to update gate, reset gate, candidate
    gates: np.ndarray   # H x 2H
    state: np.ndarray   # H x H

    def step(self, byte: np.ndarray, h: np.ndarray):
        n = h.shape[1]
        a = self.x.take(byte, axis=0)
        gate = a[:, :2 * n]
        gate += h @ self.gates
        np.clip(gate, -1, 1, out=gate)
        gate += 1
        gate *= 0.5
        z, r = gate[:, :n], gate[:, n:]
        c = a[:, 2 * n:]
        c += (r * h) @ self.state
        np.clip(c, -1, 1, out=c)
        return z, r, c, h + z * (c - h)


@dataclass
class Network:
    languages: list[str]
    ahead: Direction
    back: Direction
    out: np.ndarray    # 2H x languages
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.ahead.x, self.ahead.gates, self.ahead.state, self.back.x, self.back.gates, self.back.state,
                self.out, self.bias]


def new_network(languages: list[str], seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)

    def direction() -> Direction:
        def draw(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)
        x = draw(256, 3 * HIDDEN, scale=0.5)
        return Direction(x, draw(HIDDEN, 2 * HIDDEN, scale=0.3), draw(HIDDEN, HIDDEN, scale=0.3))
    return Network(languages, direction(), direction(),
                   rng.normal(0, 0.3, (2 * HIDDEN, len(languages))).astype(np.float32),
                   np.zeros(len(languages), np.float32))


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def gradients(net: Network, data: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over all positions of ``data`` (steps x batch) and its gradients,
    by backpropagation through time."""
    steps, batch = data.shape
    runs, states = [], []
    for d, order in ((net.ahead, range(steps)), (net.back, range(steps - 1, -1, -1))):
        h = np.zeros((batch, HIDDEN), np.float32)
        kept, hs = {}, np.zeros((steps, batch, HIDDEN), np.float32)
        for t in order:
            z, r, c, new = d.step(data[t], h)
            kept[t] = (h, z, r, c)
            h = hs[t] = new
        runs.append((d, order, kept))
        states.append(hs)
    both = np.concatenate(states, axis=2)
    p = softmax(both @ net.out + net.bias)
    loss = float(-np.log(np.maximum(p[:, np.arange(batch), label], 1e-9)).mean())
    p[:, np.arange(batch), label] -= 1
    p /= steps * batch
    d_out = np.tensordot(both, p, axes=([0, 1], [0, 1]))
    d_bias = p.sum(axis=(0, 1))
    d_both = p @ net.out.T
    grads = []
    for k, (d, order, kept) in enumerate(runs):
        dx, d_gates, d_state = np.zeros_like(d.x), np.zeros_like(d.gates), np.zeros_like(d.state)
        carry = np.zeros((batch, HIDDEN), np.float32)
        for t in reversed(order):
            h, z, r, c = kept[t]
            dh = d_both[t, :, k * HIDDEN:(k + 1) * HIDDEN] + carry
            dc = dh * z * (np.abs(c) < 1)
            d_rh = dc @ d.state.T
            d_state += (r * h).T @ dc
            dz = dh * (c - h) * 0.5 * ((z > 0) & (z < 1))
            dr = d_rh * h * 0.5 * ((r > 0) & (r < 1))
            dg = np.concatenate((dz, dr), axis=1)
            d_gates += h.T @ dg
            np.add.at(dx, data[t], np.concatenate((dg, dc), axis=1))
            carry = dh * (1 - z) + d_rh * r + dg @ d.gates.T
        grads += [dx, d_gates, d_state]
    return loss, grads + [d_out, d_bias]


def fit(pieces: list[bytes], labels: list[str], seed: int = 7) -> Network:
    """Adam on batches drawn in a fixed random order."""
    languages = sorted(set(labels))
    net = new_network(languages, seed)
    if len(languages) < 2:
        return net
    data = np.zeros((len(pieces), PIECE), np.uint8)
    for i, p in enumerate(pieces):
        data[i] = np.resize(np.frombuffer(p, np.uint8), PIECE)
    label = np.array([languages.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    n = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(data))
        for a in range(0, len(order), BATCH):
            some = order[a:a + BATCH]
            _, grads = gradients(net, data[some].T, label[some])
            n += 1
            for p, g, m, v in zip(net.parameters(), grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= STEP * (m / (1 - 0.9 ** n)) / (np.sqrt(v / (1 - 0.999 ** n)) + 1e-8)
    return net


def label_segments(net: Network, data: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Sum of each segment's language probabilities over its counting bytes, from
    ``data`` and ``inside`` (steps x segments)."""
    steps, n = data.shape
    hs = np.empty((steps, n, HIDDEN), np.float32)
    h = np.zeros((n, HIDDEN), np.float32)
    for t in range(steps):
        h = hs[t] = net.ahead.step(data[t], h)[3]
    h = np.zeros((n, HIDDEN), np.float32)
    total = np.zeros((n, len(net.languages)), np.float32)
    front, rear = net.out[:HIDDEN], net.out[HIDDEN:]
    for t in range(steps - 1, -1, -1):
        h = net.back.step(data[t], h)[3]
        h *= inside[t][:, None]
        p = hs[t] @ front
        p += h @ rear
        p += net.bias
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p *= ((inside[t] & COUNTS[data[t]]) / p.sum(axis=1))[:, None]
        total += p
    return total


def document_probabilities(net: Network, texts: list[bytes]) -> np.ndarray:
    """Mean probabilities over each text's counting bytes; all bytes are read."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    n_segments = -(-lengths // SEGMENT)
    doc = np.repeat(np.arange(len(texts)), n_segments)
    data = np.frombuffer(b"".join(t.ljust(int(k) * SEGMENT, b"\0") for t, k in zip(texts, n_segments)), np.uint8)
    data = data.reshape(-1, SEGMENT)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(n_segments) - n_segments, n_segments)
    filled = np.minimum(SEGMENT, lengths[doc] - place * SEGMENT)
    total = np.zeros((len(texts), len(net.languages)))
    for a in range(0, len(data), SIDE_BY_SIDE):
        some = slice(a, a + SIDE_BY_SIDE)
        columns = np.ascontiguousarray(data[some].T)
        inside = np.arange(SEGMENT)[:, None] < filled[some]
        np.add.at(total, doc[some], label_segments(net, columns, inside))
    return total / np.maximum(total.sum(axis=1, keepdims=True), 1e-9)


def train(docs: DataFrame) -> Network:
    """From ``docs(doc_id, text, lang)``: about ``DOCUMENTS_A_LANGUAGE`` documents
    a language, picked by a hash of id and text, and ``PIECES_A_DOCUMENT`` pieces of
    each, spread over the whole text.  The texts stay where they are read; equal
    pieces of one id count once, however often its row is repeated."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
                        & (F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5, F.lit(0)) != 0))
    counts = cut_lineage(usable.groupBy("lang").count())
    size = counts.agg(F.sum(F.octet_length("lang") + 40)).first()[0] or 0
    counts = F.broadcast(counts) if size <= BROADCAST_BYTES else counts
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.least(F.lit(1.0), DOCUMENTS_A_LANGUAGE / F.col("count")) * (1 << 30)
    picked = usable.join(counts, "lang").where(draw).select(F.xxhash64("doc_id").alias("id"), "lang", "text")

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            ids, langs, out = [], [], []
            for id_, lang, text in zip(*(batch.column(n).to_pylist() for n in ("id", "lang")), W.texts_as_bytes(pa.chunked_array([batch.column("text")]))):
                last = max(0, len(text) - PIECE)
                for at in sorted({last * k // max(1, PIECES_A_DOCUMENT - 1) for k in range(PIECES_A_DOCUMENT)}):
                    ids.append(id_)
                    langs.append(lang)
                    out.append(text[at:at + PIECE])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(out, pa.binary())],
                                             names=["id", "lang", "piece"])

    pieces = picked.mapInArrow(cut, "id long, lang string, piece binary").distinct()
    rows = sorted((r.lang, bytes(r.piece)) for r in pieces.select("lang", "piece").collect())
    return fit([p for _, p in rows], [x for x, _ in rows])


def identify(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """``docs``, columns ``doc_id``, ``text`` and ``lang`` among them, with
    ``held_out`` (crc32 of the id, mod 5, is 0), ``lang_pred`` and ``score`` (its
    mean probability), which replace columns of these names.

    Without a network one is trained on the other documents.  A text that is null
    or has no letter is ``und`` with score 0, as is every text if nothing could be
    learned; ties go to the first language in code-point order.  A null id is not
    held out of the report and not learned from; a null ``lang`` is not learned
    from.  Repeated rows get equal results; an empty table an empty one."""
    docs = docs.drop("held_out", "lang_pred", "score")
    net = net or train(docs.select("doc_id", "text", "lang"))
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    docs = docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)))
    ready = docs.withColumn("__letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    kept = docs.columns
    names = kept + [f.name for f in added]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            letters = batch.column("__letters").to_numpy(zero_copy_only=False)
            texts = W.texts_as_bytes(pa.chunked_array([batch.column("text")]))
            begin = 0
            while begin < len(texts):
                end, size = begin, 0
                while end < len(texts) and (end == begin or size < SIDE_BY_SIDE):
                    size += -(-len(texts[end]) // SEGMENT)
                    end += 1
                if net.languages:
                    p = document_probabilities(net, [t if x else b"" for t, x in zip(texts[begin:end], letters[begin:end])])
                    best = p.argmax(axis=1)
                    pred = [net.languages[k] if x else "und" for k, x in zip(best, letters[begin:end])]
                    score = np.where(letters[begin:end], p[np.arange(len(best)), best], 0.0)
                else:
                    pred, score = ["und"] * (end - begin), np.zeros(end - begin)
                rows = batch.slice(begin, end - begin)
                columns = [rows.column(n) for n in kept]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                                 names=names)
                begin = end

    return ready.mapInArrow(run, T.StructType(docs.schema.fields + added))
