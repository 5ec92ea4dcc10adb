"""Exact set-similarity links inside one block of sets, by a signature tree.

A member's signature is a bitmap of its tokens, over the tokens that at least
two members hold.  Nodes of eight hold the OR of their children's bitmaps and
their range of set sizes.  Node pairs are compared level by level from the
root; a pair goes when its sizes cannot match, when the common bits allow too
small an overlap, or when all its members are linked already."""

from __future__ import annotations

import numpy as np

FAN = 8
SIGNATURE_BYTES = 16 << 20  # of all members of a block


def links(sizes: np.ndarray, offsets: np.ndarray, tokens: np.ndarray, labels: np.ndarray,
          percent: int = 75) -> np.ndarray:
    """Labels after joining all pairs with ``100 * overlap >= percent * union``.

    ``tokens[offsets[i]:offsets[i + 1]]`` are the distinct tokens of member ``i``
    that another set may hold; ``sizes`` its full size.  Members with equal
    ``labels`` count as linked and are not compared.  Of each joined class the
    smallest label stays."""
    m = len(sizes)
    if m < 2 or len(tokens) == 0:
        return labels
    first = np.minimum.reduceat(np.append(tokens, tokens[-1]), np.minimum(offsets[:-1], len(tokens)))
    order = np.lexsort((sizes, first))
    labels, sizes = labels[order].copy(), sizes[order].astype(np.int64)
    lengths = np.diff(offsets)[order]
    owner = np.repeat(np.arange(m), lengths)
    at = np.concatenate([np.arange(offsets[i], offsets[i + 1]) for i in order])
    _, ids, held = np.unique(tokens[at], return_inverse=True, return_counts=True)
    shared = held[ids] > 1
    owner, ids = owner[shared], np.unique(ids[shared], return_inverse=True)[1]
    if len(ids) == 0:
        return _unsorted(labels, order)
    total = int(ids.max()) + 1
    words = min(-(-total // 64), max(1, SIGNATURE_BYTES // 8 // m))
    a_bit = -(-total // (words * 64))  # tokens that a bit may stand for
    bit = ids % (words * 64)
    signature = np.zeros((m, words), np.uint64)
    np.bitwise_or.at(signature, (owner, bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
    begin = np.searchsorted(owner, np.arange(m + 1))
    ids_of = [np.sort(ids[begin[i]:begin[i + 1]]) for i in range(m)] if a_bit > 1 else []

    levels = [(signature, sizes, sizes)]
    while len(levels[-1][0]) > 1:
        bits, low, high = levels[-1]
        cut = np.arange(0, len(bits), FAN)
        levels.append((np.bitwise_or.reduceat(bits, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)))
    step = max(1, (4 << 20) // (8 * words))

    def possible(level: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        bits, low, high = levels[level]
        fit = (100 * high[x] >= percent * low[y]) & (100 * high[y] >= percent * low[x])
        for a in range(0, len(x), step):
            s = slice(a, a + step)
            most = np.bitwise_count(bits[x[s]] & bits[y[s]]).sum(axis=1, dtype=np.int64) * a_bit
            most = np.minimum(most, np.minimum(high[x[s]], high[y[s]]))
            fit[s] &= (100 + percent) * most >= percent * (low[x[s]] + low[y[s]])
        return fit

    def mixed(level: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        cut = np.arange(0, m, FAN ** level)
        low, high = np.minimum.reduceat(labels, cut), np.maximum.reduceat(labels, cut)
        return (low[x] != high[x]) | (low[y] != high[y]) | (low[x] != low[y])

    def join(x: np.ndarray, y: np.ndarray) -> None:
        """Members pairs that pass the bound; at one token a bit it is exact."""
        open_ = labels[x] != labels[y]
        x, y = x[open_], y[open_]
        fit = possible(0, x, y)
        for i, j in zip(x[fit].tolist(), y[fit].tolist()):
            if labels[i] == labels[j]:
                continue
            if a_bit > 1:
                overlap = len(np.intersect1d(ids_of[i], ids_of[j], assume_unique=True))
                if (100 + percent) * overlap < percent * (sizes[i] + sizes[j]):
                    continue
            small, large = sorted((labels[i], labels[j]))
            labels[labels == large] = small

    def children(level: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(levels[level - 1][0])
        i = (x[:, None, None] * FAN + np.arange(FAN)[:, None]) + np.zeros((1, 1, FAN), np.int64)
        j = (y[:, None, None] * FAN + np.arange(FAN)) + np.zeros((1, FAN, 1), np.int64)
        keep = (i < n) & (j < n) & ((i < j) if level == 1 else (i <= j))
        return i[keep], j[keep]

    # Neighbours in the order of first tokens first: near copies join early.
    near = np.arange(m - 1)
    for a in range(0, m - 1, step):
        join(near[a:a + step], near[a:a + step] + 1)
    join(np.zeros(m - 1, np.int64), near + 1)
    x = y = np.zeros(1, np.int64)
    for level in range(len(levels) - 1, 0, -1):
        if level > 1:
            keep = mixed(level, x, y)
            x, y = x[keep], y[keep]
            x, y = children(level, x, y)
            keep = mixed(level - 1, x, y)
            x, y = x[keep], y[keep]
            keep = possible(level - 1, x, y)
            x, y = x[keep], y[keep]
        else:
            for a in range(0, len(x), 1024):
                u, v = x[a:a + 1024], y[a:a + 1024]
                keep = mixed(1, u, v)
                if keep.any():
                    join(*children(1, u[keep], v[keep]))
    return _unsorted(labels, order)


def _unsorted(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    out = np.empty_like(values)
    out[order] = values
    return out
