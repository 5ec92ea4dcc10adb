"""Phrase collocations against a brute-force version."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from small import DOCS, frame, odd_documents, tuples, with_clashes
from termite.llm import collocations as C


def brute(rows, min_count, max_words=5, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        inside = {p[i:j] for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                  if j - i < len(p) and counts[p[i:j]] <= a}
        found = []
        for p, a in candidates.items():
            if p not in inside:
                score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out, key=repr)


def sentences(rng, n_docs):
    """Texts of common words with phrases of all lengths and frequencies."""
    phrases = ["new york", "in spite of", "as well as the", "once upon a time there", "so so so", "Ünder der Brücke"]
    rows = []
    for i in range(n_docs):
        words = []
        for _ in range(rng.randrange(60)):
            words.append(rng.choice(phrases) if rng.random() < 0.3 else f"w{int(rng.paretovariate(0.7)) % 50}")
            if rng.random() < 0.2:
                words[-1] += rng.choice([".", ",", "\n", "!?", ";\t"])
        rows.append((i, rng.choice([" ", "  ", "\t"]).join(words), rng.choice(["en", "en", "de", None, "und"]), "s", 1))
    return rows


# Few suffixes a task make most words and many phrases hot; no listed words leave all words in.
@pytest.mark.parametrize("task_suffixes", [1 << 20, 40, 3])
@pytest.mark.parametrize("listed_words", [1 << 20, 0])
def test_phrases_of_small_corpora(spark, task_suffixes, listed_words):
    rows = sentences(random.Random(5), 150)
    got = C.collocations(frame(spark, rows), 3, task_suffixes=task_suffixes, listed_words=listed_words)
    want = brute(rows, 3)
    assert len(want) > 300 and tuples(got) == want


def test_top_phrases_of_parts(spark, monkeypatch):
    monkeypatch.setattr(C, "RANKED_IN_A_TASK", 50)
    rows = sentences(random.Random(6), 120)
    assert tuples(C.collocations(frame(spark, rows), 3, max_words=3, top=7)) == brute(rows, 3, 3, 7)


def test_odd_documents_and_clashing_columns(spark):
    rows = odd_documents() + [(50, "A b a B a b", "en", "s", 1), (51, "a b.a b", None, "s", 1)]
    assert tuples(C.collocations(with_clashes(frame(spark, rows)), 2, top=None)) == brute(rows, 2, top=10 ** 9)


def test_empty_table(spark):
    got = C.collocations(frame(spark, [], DOCS))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and got.count() == 0


def test_scores_beyond_64_bits(spark):
    a, n, parts = 3 * 10 ** 14 + 7, 9 * 10 ** 15 + 1, 7 * 10 ** 14 + 3
    got = spark.sql(f"select (1000 * cast({a} as decimal(38,0)) * cast({n} as decimal(38,0))) div "
                    f"(cast({parts} as decimal(38,0)) * cast({parts} as decimal(38,0)))").first()[0]
    assert got == 1000 * a * n // parts ** 2


def test_frequent_prefixes_against_counts():
    rng = np.random.default_rng(3)
    for _ in range(40):
        rows = rng.integers(0, 4, (int(rng.integers(1, 300)), 4))
        for row in rows:
            if rng.random() < 0.3:
                row[rng.integers(1, 4):] = C.END
        weights = rng.integers(1, 4, len(rows))
        want = Counter()
        for row, w in zip(rows.tolist(), weights.tolist()):
            for k in range(1, 5):
                if C.END not in row[:k]:
                    want[tuple(row[:k])] += w
        got = C.frequent_prefixes(list(rows.T), weights, 9)
        assert sorted((tuple(rows[i, :k].tolist()), f) for i, k, f in got) == sorted(x for x in want.items() if x[1] >= 9)
