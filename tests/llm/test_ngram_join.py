"""Components of the similarity join against a brute-force version."""

import random
import re

import numpy as np
import pytest

from small import DOCS, frame, odd_documents, prose, tuples, with_clashes
from termite.llm import ngram_join as N
from termite.llm.components import components
from termite.llm.ngram_join import near_duplicates, one_of_each
from termite.llm.signature_tree import links


def shingles(text, width=5):
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
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                label[top(i)] = top(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[top(i)] = min(r[0], least.get(top(i), r[0]))
    return sorted(((r[0], len(sets[i]), least.get(top(i))) for i, r in enumerate(rows)), key=repr)


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


# A task weight of 300 makes every family a heavy group of many blocks.
@pytest.mark.parametrize("task_weight", [1 << 20, 3000, 300])
@pytest.mark.parametrize("change", [0.01, 0.03, 0.06])
def test_families_of_near_copies(spark, task_weight, change):
    rng = random.Random(int(1000 * change))
    rows = near_copies(rng, 5, 14, 60, change) + [(1000 + i, prose(500 + i, 40, 3000), "en", "s", 1) for i in range(10)]
    rows += [(2000 + i, rows[i][1].upper(), "en", "s", 1) for i in range(5)]
    got = near_duplicates(frame(spark, rows), chunk_bytes=3000, task_weight=task_weight)
    assert tuples(got, "doc_id", "n_shingles", "component_id") == brute(rows)


def template_documents(rng, n, passages):
    """Four passages of a stock each, hardly any two linked; every 25th is the
    one before it with a word changed."""
    stock = [prose(7000 + i, 24, 100_000) for i in range(passages)]
    rows = []
    for i in range(n):
        text = " ".join(rng.sample(stock, 4))
        if i % 25 == 24:
            words = rows[-1][1].split()
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        rows.append((i, text, "en", "s", 1))
    return rows


def dealt_copies(monkeypatch):
    """The members that each call of the task join is dealt."""
    seen, join = [], N._join_tasks

    def counted(members, percent):
        seen.append(members.count())
        return join(members, percent)
    monkeypatch.setattr(N, "_join_tasks", counted)
    return seen


# 600: the lists themselves are too long for a task.
@pytest.mark.parametrize("task_weight", [6000, 600])
def test_chained_templates(spark, task_weight):
    rows = template_documents(random.Random(11), 250, 100)
    got = near_duplicates(frame(spark, rows), task_weight=task_weight)
    assert tuples(got, "doc_id", "n_shingles", "component_id") == brute(rows)


def test_chained_templates_are_dealt_few_copies(spark, monkeypatch):
    seen, copies = dealt_copies(monkeypatch), []
    for n in (300, 900):
        rows = template_documents(random.Random(12), n, 200)
        near_duplicates(frame(spark, rows), task_weight=2000).count()
        copies.append([x / n for x in seen[-2:]])
    # A member is in few lists, however many members its group has: blocks alone deal 181 copies at 900.
    assert all(first < 4 and second < 4 for first, second in copies)


def test_chains_across_size_bands(spark):
    """Each text is a longer start of one sequence: neighbours link, ends do not."""
    words = prose(3, 400, 100_000).split()
    rows = [(i, " ".join(words[:n]), "en", "s", 1) for i, n in enumerate([20, 24, 29, 35, 43, 54, 68, 86, 110, 140, 180, 230, 300, 400])]
    rows += [(100 + i, " ".join(words[:n]), "en", "s", 1) for i, n in enumerate([6, 7, 8, 9, 10])]
    for weight in (1 << 20, 200):
        got = near_duplicates(frame(spark, rows), task_weight=weight)
        assert tuples(got, "doc_id", "n_shingles", "component_id") == brute(rows)


def test_odd_documents_and_clashing_columns(spark):
    rows = odd_documents() + [(20, "a b c", "en", "s", 1), (21, "A B C", "en", "s", 1), (22, "a b", "en", "s", 1)]
    docs = with_clashes(frame(spark, rows))
    assert tuples(near_duplicates(docs), "doc_id", "n_shingles", "component_id") == brute(rows)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    # 4 twice, 8 and 9, 20 and 21 are copies; texts without words all stay.
    assert ids == sorted([1, 2, 3, None, 4, 5, 6, 7, None, 8, 20, 22], key=repr)


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [], DOCS)).count() == 0
    assert one_of_each(frame(spark, [], DOCS)).count() == 0


def test_signature_tree_against_all_pairs():
    rng = np.random.default_rng(4)
    for _ in range(60):
        m = int(rng.integers(1, 70))
        pool = [rng.choice(400, int(rng.integers(4, 40)), replace=False) for _ in range(4)]
        sets = []
        for _ in range(m):
            base = pool[int(rng.integers(4))]
            s = set(base[rng.random(len(base)) > 0.12].tolist()) | set(rng.choice(400, int(rng.integers(0, 3))).tolist())
            sets.append(s)
        tokens = np.array([x for s in sets for x in sorted(s)], np.int64)
        offsets = np.cumsum([0] + [len(s) for s in sets])
        sizes = np.array([len(s) for s in sets])
        got = links(sizes, offsets, tokens, np.arange(m))
        want = list(range(m))
        for i in range(m):
            for j in range(i):
                if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    a, b = want[i], want[j]
                    want = [min(a, b) if x in (a, b) else x for x in want]
        assert got.tolist() == want


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = dict(tuples(components(spark.createDataFrame(edges, "u long, v long"))))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
