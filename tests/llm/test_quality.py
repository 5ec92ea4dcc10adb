"""Quality rules against a brute-force version."""

import random
import re
from collections import Counter

import numpy as np

from small import DOCS, frame, odd_documents, prose, tuples, with_clashes
from termite.llm.quality import ADDED, longest_repeats, quality


def repeat_from(words, i):
    best = 0
    for j in range(len(words)):
        if j != i:
            k = 0
            while max(i, j) + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            best = max(best, k)
    return best


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    repeat = [repeat_from(words, i) for i in range(len(words))]
    eight, five = set(), set()
    for i, k in enumerate(repeat):
        eight.update(range(i, i + 8) if k >= 8 else ())
        five.update(range(i, i + k) if k >= 5 else ())
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    failed = n < 20 or 100 * len(eight) > 30 * n
    longest = max(repeat, default=0)
    return (n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), sum(c - 1 for c in Counter(lines).values()),
            len(eight), len(five), longest, failed, not failed and 100 * len(five) <= 40 * n and longest <= 100)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat",
           "base_failed", "kept")


def test_random_documents(spark):
    rng = random.Random(2)
    rows = []
    for i in range(50):
        parts = [prose(rng.randrange(8), rng.choice([3, 6, 9, 30]), 12) for _ in range(rng.randrange(1, 6))]
        rows.append((i, rng.choice(["\n", " ", " é# ", "\n \n"]).join(parts), "en", "s", 1))
    twice = prose(77, 110, 1_000_000)
    rows += [(100, twice + " " + prose(78, 600, 1_000_000) + " " + twice, "en", "s", 1), (101, "a " * 300, "en", "s", 1)]
    got = {r[0]: r[1:] for r in tuples(quality(frame(spark, rows)), "doc_id", *COLUMNS)}
    assert got == {r[0]: brute(r[1]) for r in rows}
    assert got[100][-2:] == (False, False)  # only the long repeat is against it


def test_odd_documents_and_clashing_columns(spark):
    rows = [r for r in odd_documents() if r[0] != 5]
    docs = with_clashes(frame(spark, rows))
    got = quality(docs)
    assert sorted(got.columns) == sorted(set(docs.columns) | set(ADDED.names))
    assert tuples(got, "doc_id", *COLUMNS) == sorted(((r[0], *brute(r[1])) for r in rows), key=repr)
    long = [r for r in odd_documents() if r[0] == 5]
    assert tuples(quality(frame(spark, long)), "n_words", "n_repeat_words", "kept") == [(30_000, 0, True)]
    assert quality(frame(spark, [], DOCS)).count() == 0


def test_longest_repeats_of_a_periodic_text():
    ids = np.array([1, 2] * 1000)
    got = longest_repeats(ids, np.zeros(2000, np.int64))
    assert got[:4].tolist() == [1998, 1997, 1998, 1997] and got[-1] == 1
    assert longest_repeats(np.array([5, 5]), np.array([0, 1])).tolist() == [0, 0]
