"""Unigram segmentation lattices of many words at once (numpy, inside tasks).

An edge of a word's lattice is a vocabulary piece that matches its bytes at some
place.  A word is written with a leading space, so pieces that begin a word match
only there; single bytes are pieces, so every word has a segmentation."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 1 << 17  # bytes of words handled at a time


@dataclass
class Trie:
    """``arcs``: sorted ``node * 256 + byte``; arc ``i`` leads to node ``i + 1``;
    ``piece`` of a node, or -1."""

    arcs: np.ndarray
    piece: np.ndarray
    depth: int

    def table(self) -> np.ndarray:
        out = np.zeros((len(self.piece), 256), np.int32)
        out.reshape(-1)[self.arcs] = np.arange(1, len(self.arcs) + 1)
        return out


def build_trie(pieces: list[bytes]) -> Trie:
    """Nodes are the prefixes, numbered level by level in order of their arcs."""
    prefixes = sorted({p[:k] for p in pieces for k in range(1, len(p) + 1)}, key=lambda x: (len(x), x))
    number = {b"": 0} | {x: i + 1 for i, x in enumerate(prefixes)}
    arcs = np.array([number[x[:-1]] * 256 + x[-1] for x in prefixes], np.int64)
    piece = np.full(len(prefixes) + 1, -1, np.int32)
    for i, p in enumerate(pieces):
        piece[number[p]] = i
    return Trie(arcs, piece, max(map(len, pieces)))


@dataclass
class Lattice:
    """Edges ``start -> end`` between nodes; word ``w`` has nodes ``first[w] ..
    last[w]``; ``offset`` of a node from its word's first."""

    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    first: np.ndarray
    last: np.ndarray
    offset: np.ndarray


def lattice(words: list[bytes], trie: Trie, table: np.ndarray) -> Lattice:
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    data = np.frombuffer(b" " + b" ".join(words), np.uint8)
    begin = np.concatenate(([0], np.cumsum(lengths)))  # bytes; nodes have one more a word
    word = np.repeat(np.arange(len(words)), lengths)
    at = np.arange(len(data))
    node, starts, ends, pieces = np.zeros(len(data), np.int32), [], [], []
    for d in range(trie.depth):
        inside = at + d < begin[word + 1]
        at, word, node = at[inside], word[inside], node[inside]
        node = table[node, data[at + d]]
        alive = node > 0
        at, word, node = at[alive], word[alive], node[alive]
        if len(at) == 0:
            break
        full = trie.piece[node] >= 0
        starts.append(at[full] + word[full])
        ends.append(at[full] + word[full] + d + 1)
        pieces.append(trie.piece[node[full]])
    first = begin[:-1] + np.arange(len(words))
    last = first + lengths
    offset = np.arange(len(data) + len(words)) - np.repeat(first, lengths + 1)
    return Lattice(np.concatenate(starts), np.concatenate(ends), np.concatenate(pieces), first, last, offset)


def _log_sums(value: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups (runs of equal values) and the log of the sum of ``exp(value)``."""
    cut = np.flatnonzero(np.diff(group, prepend=-1))
    most = np.maximum.reduceat(value, cut)
    total = np.add.reduceat(np.exp(value - np.repeat(most, np.diff(cut, append=len(value)))), cut)
    return group[cut], most + np.log(total)


def _sweep(graph: Lattice, log_p: np.ndarray, forward: bool) -> np.ndarray:
    """Log of the weight of all paths from each word's first node to each node, or
    from each node to its word's last."""
    near, far = (graph.end, graph.start) if forward else (graph.start, graph.end)
    steps = graph.offset[near]
    order = np.lexsort((near, steps if forward else -steps))
    near, far, weight, steps = near[order], far[order], log_p[graph.piece[order]], steps[order]
    out = np.full(len(graph.offset), -np.inf)
    out[graph.first if forward else graph.last] = 0.0
    cut = np.flatnonzero(np.diff(steps, prepend=-1, append=-1))
    for a, b in zip(cut[:-1], cut[1:]):
        nodes, sums = _log_sums(out[far[a:b]] + weight[a:b], near[a:b])
        out[nodes] = sums
    return out


def blocks(words: list[bytes]):
    begin, size = 0, 0
    for i, w in enumerate(words):
        size += len(w) + 1
        if size >= BLOCK:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(words):
        yield begin, len(words)


def marginals(words: list[bytes], trie: Trie, log_p: np.ndarray) -> np.ndarray:
    """Natural log of each word's probability, summed over its segmentations."""
    table, out = trie.table(), np.zeros(len(words))
    for a, b in blocks(words):
        graph = lattice(words[a:b], trie, table)
        out[a:b] = _sweep(graph, log_p, True)[graph.last]
    return out


def expected_counts(words: list[bytes], weight: np.ndarray, trie: Trie, log_p: np.ndarray) -> np.ndarray:
    """How often each piece is used over all segmentations of the words, each
    weighted by its probability given the word and the word by ``weight``."""
    table, out = trie.table(), np.zeros(len(log_p))
    for a, b in blocks(words):
        graph = lattice(words[a:b], trie, table)
        ahead, behind = _sweep(graph, log_p, True), _sweep(graph, log_p, False)
        word = np.searchsorted(graph.first, graph.start, side="right") - 1
        share = np.exp(ahead[graph.start] + log_p[graph.piece] + behind[graph.end] - ahead[graph.last][word])
        out += np.bincount(graph.piece, weights=share * weight[a:b][word], minlength=len(log_p))
    return out
