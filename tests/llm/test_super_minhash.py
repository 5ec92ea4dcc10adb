"""Components of the SuperMinHash operator against a brute-force version."""

import random
import re

import numpy as np
import pytest

from small import DOCS, frame, odd_documents, prose, tuples, with_clashes
from termite.llm import super_minhash as S


def shingles(text, width=4):
    t = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(t[i:i + width]) for i in range(max(1, len(t) - width + 1))} if t else set()


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                label[top(i)] = top(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[top(i)] = min(r[0], least.get(top(i), r[0]))
    found = [least.get(top(i)) for i in range(len(rows))]
    return sorted(((r[0], len(s), c, r[0] == c) for r, s, c in zip(rows, sets, found)), key=repr)


def near_copies(rng, n_families, copies, length, change):
    rows, k = [], 0
    for f in range(n_families):
        base = prose(f, length, 3000).split()
        for _ in range(copies):
            words = [w if rng.random() > change else f"x{rng.randrange(50)}" for w in base]
            rows.append((k, " ".join(words), "en", "s", 1))
            k += 1
    rng.shuffle(rows)
    return rows


# Small tasks split every family; both verifications meet in blocks.
@pytest.mark.parametrize("limits", [{}, {"task_members": 3, "task_bytes": 1500}])
@pytest.mark.parametrize("change", [0.01, 0.025, 0.05])
def test_families_of_near_copies(spark, limits, change):
    rng = random.Random(int(1000 * change))
    rows = near_copies(rng, 5, 20, 80, change) + [(1000 + i, prose(500 + i, 40, 3000), "en", "s", 1) for i in range(10)]
    rows += [(2000 + i, rows[i][1].upper(), "en", "s", 1) for i in range(5)]
    want = brute(rows)
    assert 10 < sum(kept for *_, kept in want) < 110
    assert tuples(S.near_duplicates(frame(spark, rows), **limits)) == want


@pytest.mark.parametrize("limits", [{}, {"task_members": 2, "task_bytes": 500}])
def test_chains_of_growing_texts(spark, limits):
    """Each text is a longer start of one sequence: neighbours link, ends do not."""
    words = prose(3, 400, 100_000).split()
    rows = [(i, " ".join(words[:n]), "en", "s", 1) for i, n in enumerate([20, 24, 28, 34, 41, 50, 61, 75, 92, 114, 141, 175, 217, 270, 336])]
    rows += [(100 + i, " ".join(words[:n]), "en", "s", 1) for i, n in enumerate([4, 5, 6, 7, 8, 9, 10])]
    assert tuples(S.near_duplicates(frame(spark, rows), **limits)) == brute(rows)


def test_second_verification_alone(spark, monkeypatch):
    """Without a first verification all links are found among components."""
    monkeypatch.setattr(S, "LED_BANDS", 10 ** 6)
    rows = near_copies(random.Random(9), 4, 12, 70, 0.02)
    assert tuples(S.near_duplicates(frame(spark, rows), task_members=4, task_bytes=2000)) == brute(rows)


def test_joins_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_ROWS", 0)
    rows = near_copies(random.Random(8), 4, 8, 70, 0.03)
    assert tuples(S.near_duplicates(frame(spark, rows))) == brute(rows)


def test_odd_documents_and_clashing_columns(spark):
    rows = odd_documents() + [(20, "a b c", "en", "s", 1), (21, "A B C", "en", "s", 1), (22, "a b", "en", "s", 1)]
    docs = with_clashes(frame(spark, rows))
    assert tuples(S.near_duplicates(docs)) == brute(rows)


def test_empty_table(spark):
    got = S.near_duplicates(frame(spark, [], DOCS))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"] and got.count() == 0


def plain_signature(value, slots):
    """The published algorithm, an element at a time, all steps."""
    best = [None] * slots
    for v in value:
        p = list(range(slots))
        for j in range(slots):
            draw = int(S.W.mix(np.array([(int(v) + (j + 1) * S.W.BASE) & (2 ** 64 - 1)], np.uint64))[0])
            k = j + ((draw & 0xFFFFFFFF) * (slots - j) >> 32)
            p[j], p[k] = p[k], p[j]
            offer = (draw >> 32) | (j << 32)
            best[p[j]] = offer if best[p[j]] is None else min(best[p[j]], offer)
    return best


def test_early_stopping_changes_nothing(monkeypatch):
    monkeypatch.setattr(S, "SLICE", 37)
    rng = np.random.default_rng(1)
    sizes = [1, 2, 7, 40, 0, 90, 300]
    doc = np.repeat(np.arange(len(sizes)), sizes)
    value = rng.integers(0, 2 ** 63, len(doc)).astype(np.uint64)
    got = S.signatures(doc, value, len(sizes), 24)
    for i, n in enumerate(sizes):
        want = plain_signature(value[doc == i], 24) if n else [int(S.UNSET)] * 24
        assert got[i].tolist() == want


def test_estimates_vary_less_than_with_independent_slots():
    rng = np.random.default_rng(2)
    found = []
    for _ in range(150):
        x = rng.integers(0, 2 ** 63, 44).astype(np.uint64)
        s = S.signatures(np.repeat([0, 1], 40), np.concatenate((x[:40], x[4:])), 2)
        found.append((s[0] == s[1]).mean())
    p = 36 / 44
    assert abs(np.mean(found) - p) < 0.01 and np.std(found) < 0.9 * (p * (1 - p) / S.SLOTS) ** 0.5
