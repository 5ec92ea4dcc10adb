"""Lattice scores against sums over all segmentations."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from small import DOCS, frame, odd_documents, prose, tuples, with_clashes
from termite.llm.lattice import build_trie, expected_counts, marginals
from termite.llm.lattice_lm import Vocabulary, read_vocabulary, score

PIECES = sorted({bytes([b]) for b in range(256)} | {b" a", b"ab", b"b", b"abc", b" ab", b"bc", b"ca", "é".encode(), "né".encode()})


def segmentations(data):
    if not data:
        yield ()
    for k in range(1, len(data) + 1):
        if data[:k] in PIECES:
            for rest in segmentations(data[k:]):
                yield (data[:k], *rest)


def test_marginals_and_expected_counts():
    rng = np.random.default_rng(1)
    p = rng.random(len(PIECES))
    log_p = np.log(p / p.sum())
    weight = dict(zip(PIECES, p / p.sum()))
    words = [b"a", b"abc", b"abcabcab", "néa".encode(), b"zz", b"\xff" * 3]
    trie = build_trie(PIECES)
    got = marginals(words, trie, log_p)
    want, use = [], Counter()
    for k, w in enumerate(words, 1):
        paths = [(math.prod(weight[x] for x in s), s) for s in segmentations(b" " + w)]
        total = sum(x for x, _ in paths)
        want.append(math.log(total))
        for x, s in paths:
            for piece in s:
                use[piece] += k * x / total
    assert np.allclose(got, want, rtol=1e-12)
    counts = expected_counts(words, np.arange(1, 7), trie, log_p)
    assert np.allclose(counts, [use[x] for x in PIECES], atol=1e-9)


def test_long_words_do_not_underflow():
    trie = build_trie(PIECES)
    log_p = np.full(len(PIECES), -math.log(len(PIECES)))
    assert np.isfinite(marginals([b"abc" * 5000], trie, log_p)).all()


def brute(rows, vocabulary):
    """Base score by counting; the model trained and applied word by word."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")) for r in rows]
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 1 for r in rows]
    count = Counter(w for t, h in zip(words, held) if not h for w in t)
    docs = held.count(False)
    n, v = sum(count.values()) + docs, len(count) + (docs > 0)
    trie = build_trie(vocabulary.pieces)
    names = [w.encode() for w in count]
    use = expected_counts(names, np.array(list(count.values())), trie, vocabulary.log_p) if names else np.zeros(len(vocabulary.pieces))
    mass = use.sum() + docs + 0.5 * (len(use) + 1)
    log_p = np.log((use + 0.5) / mass)
    base = lambda c: math.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    out = []
    for r, t, h in zip(rows, words, held):
        s = marginals([w.encode() for w in t], trie, log_p).sum() / math.log(10) if t else 0.0
        out.append((r[0], h, len(t) + 1, sum(count[w] > 0 for w in t) + (docs > 0), n,
                    sum(base(count[w]) for w in t) + base(docs), s + math.log10((docs + 0.5) / mass)))
    return out


@pytest.mark.parametrize("rows", [
    [(i, prose(i % 17, 5 + i % 40, 90) + " Étude Abc", "en", "s", 1) for i in range(60)],
    [r for r in odd_documents() if r[0] != 5],
    [(i, "only held out", "en", "s", 1) for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1]])
def test_scores(spark, rows):
    vocabulary = Vocabulary(PIECES, np.full(len(PIECES), -math.log(len(PIECES))))
    got = sorted((tuple(r) for r in score(with_clashes(frame(spark, rows)), vocabulary, chunk_bytes=500).collect()), key=repr)
    want = sorted(brute(rows, vocabulary), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-6)


def test_empty_table(spark):
    assert score(frame(spark, [], DOCS)).count() == 0


def test_public_vocabulary():
    vocabulary = read_vocabulary()
    assert len(vocabulary.pieces) > 20_000 and math.isclose(np.exp(vocabulary.log_p).sum(), 1)
    assert all(bytes([b]) in vocabulary.pieces for b in range(256))
    assert not any(re.search(rb"[A-Z]|.\s", p) for p in vocabulary.pieces if len(p) > 1)
