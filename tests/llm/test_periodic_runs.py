"""Periodic runs against a brute-force version."""

import random
import re

import numpy as np
import pytest

from small import DOCS, frame, odd_documents, prose, tuples, with_clashes
from termite.llm.periodic_runs import ADDED, periodic_runs, runs


def brute(words, min_length=6, min_exponent=4):
    """Every stretch that period q holds and no neighbour extends; of equal
    stretches, the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, min_exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, m, q) for (s, m), q in found.items())


def collapse(words, found):
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_words(rng, letters):
    out = []
    for _ in range(rng.randrange(1, 7)):
        root = [rng.choice(letters) for _ in range(rng.randrange(1, 14))]
        out += (root * rng.randrange(1, 9))[:rng.randrange(1, 90)]
        out += [rng.choice(letters) for _ in range(rng.randrange(4))]
    return out


@pytest.mark.parametrize("letters", ["ab", "abc", "abcdefghij"])
@pytest.mark.parametrize("exponent", [3, 4])
def test_runs_of_many_documents_at_once(letters, exponent):
    rng = random.Random(len(letters))
    docs = [periodic_words(rng, letters) for _ in range(120)] + [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 700]
    ids = np.array([ord(w) for d in docs for w in d], np.int64)
    offsets = np.cumsum([0] + [len(d) for d in docs])
    got = runs(ids, offsets, 6, exponent)
    want = [(int(offsets[k]) + s, m, q) for k, d in enumerate(docs) for s, m, q in brute(d, 6, exponent)]
    assert [tuple(r) for r in got.tolist()] == want


def test_runs_inside_runs():
    inner = "a a a a a a a b".split()
    words = ["x"] + inner * 5 + ["y"]
    got = [tuple(r) for r in runs(np.array([ord(w) for w in words]), np.array([0, len(words)])).tolist()]
    assert got == brute(words) and (1, 40, 8) in got and (1, 7, 1) in got and len(got) == 6


def test_odd_documents_and_clashing_columns(spark):
    rng = random.Random(2)
    rows = odd_documents() + [(30 + i, rng.choice([" ", "\n", "\t"]).join(periodic_words(rng, "abc")), "en", "s", 1)
                              for i in range(40)] + [(80, " ".join(prose(4, 700).split() * 5), "en", "s", 1)]
    docs = with_clashes(frame(spark, rows))
    got = periodic_runs(docs)
    assert got.columns == [c for c in docs.columns if c not in ADDED.names] + ADDED.names
    want = []
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")
        found = brute(words) if len(words) < 5000 else [tuple(x) for x in runs(
            np.unique(words, return_inverse=True)[1], np.array([0, len(words)])).tolist()]
        want.append((r[0], r[1], len(words), found, collapse(words, found)))
    assert [(i, t, n, [tuple(x) for x in f], c) for i, t, n, f, c in tuples(got, "doc_id", "text", *ADDED.names)] == sorted(
        want, key=repr)


def test_empty_table(spark):
    assert periodic_runs(frame(spark, [], DOCS)).count() == 0
