"""Removal of repeated windows against a brute-force version."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from small import DOCS, frame, odd_documents, prose, tuples, with_clashes
from termite.llm import words as W
from termite.llm.substring_dedup import remove_repeats, without_removed


def brute(rows, window):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows]
    seen = Counter(tuple(t[i:i + window]) for t in texts for i in range(len(t) - window + 1))
    out = []
    for r, t in zip(rows, texts):
        gone = set()
        for i in range(len(t) - window + 1):
            if seen[tuple(t[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(t) if i not in gone)
        out.append((r[0], len(t), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [3, 35])
def test_random_documents_with_shared_passages(spark, window):
    rng = random.Random(5)
    shared = [prose(100 + i, 40 + 10 * i) for i in range(6)]
    rows = []
    for i in range(60):
        parts = [prose(i, rng.randrange(1, 90))] + [rng.choice(shared) for _ in range(rng.randrange(3))] + [prose(1000 + i, 20)]
        rows.append((i, rng.choice([" ", "\n", "\t\x0b"]).join(parts), "en", "s", 1))
    got = remove_repeats(frame(spark, rows), window, with_text=False, chunk_bytes=2000)
    assert tuples(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute(rows, window)


def test_odd_documents_and_clashing_columns(spark):
    rows = odd_documents()
    docs = with_clashes(frame(spark, rows))
    got = remove_repeats(docs, 35)
    assert tuples(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute(rows, 35)
    by_id = {(r.doc_id, r.source): r.text for r in got.collect()}
    assert by_id[(1, "a")] is None and by_id[(2, "a")] == "" and by_id[(3, None)] == " \t\n "
    assert by_id[(8, "b")] == "" and by_id[(5, "a")].startswith("l0x0 l1x1")
    assert [c for c in got.columns if c in docs.columns and c != "n_words"] == [c for c in docs.columns if c != "n_words"]


def test_empty_table(spark):
    assert remove_repeats(frame(spark, [], DOCS)).count() == 0


def test_kept_runs_stay_as_written():
    text = "a  b\nc d\te".encode()
    assert without_removed(text, np.array([0, 0, 0, 0, 0], bool)) == text
    assert without_removed(text, np.array([0, 0, 1, 0, 0], bool)) == b"a  b d\te"
    assert without_removed(text, np.array([1, 1, 1, 1, 1], bool)) == b""


def test_window_hashes_are_position_free():
    x = np.array([5, 7, 9, 5, 7, 9, 1], np.uint64)
    h = W.window_hashes(x, 3)
    assert h[0] == h[3] and len(set(h.tolist())) == 4
    assert len(W.window_hashes(x, 8)) == 0
