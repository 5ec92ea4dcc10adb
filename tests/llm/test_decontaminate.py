"""Benchmark hits against a brute-force version; removal of spans and documents."""

import hashlib
import re

from small import DOCS, frame, odd_documents, prose, tuples, with_clashes
from termite.llm import decontaminate as D

ITEMS = [(1, prose(50, 14)), (2, prose(51, 10)), (10, "Short item, four WORDS"), (3, None), (4, " .,; "), (5, prose(50, 14)),
         (6, "één")]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items):
    wins = set()
    for item, text in items:
        t = words(text)
        wins |= {(tuple(t[i:i + 10]), item) for i in range(max(1, len(t) - 9))} if t else set()
    out = []
    for r in rows:
        t, hit, found = words(r[1]), set(), set()
        for win, item in wins:
            for i in range(len(t) - len(win) + 1):
                if tuple(t[i:i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    found.add("" if item is None else str(item))
        ids = ",".join(sorted(found))
        out.append((r[0], len(t), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def documents():
    rows = odd_documents()
    rows += [(100, prose(60, 8) + "! " + prose(50, 14).upper().replace(" ", ", ") + ". " + prose(61, 5), "en", "s", 1),
             (101, prose(50, 9), "en", "s", 1), (102, prose(51, 10) + " short-item: FOUR words " + prose(50, 12), "en", "s", 1),
             (103, "één één", "fr", "s", 1), (103, "één één", "fr", "s", 1), (104, "(Short item), four words; and more.", "en", "s", 1)]
    return rows


def items(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_report(spark):
    rows = documents()
    docs = with_clashes(frame(spark, rows))
    assert tuples(D.report(docs, items(spark))) == brute(rows, ITEMS)


def test_report_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_BYTES", -1)
    rows = documents()
    assert tuples(D.report(frame(spark, rows), items(spark))) == brute(rows, ITEMS)


def test_null_item_id_and_empty_tables(spark):
    some = [(None, "no id here at all"), (7, "one")]
    rows = odd_documents()
    assert tuples(D.report(frame(spark, rows), items(spark, some))) == brute(rows, some)
    assert D.report(frame(spark, [], DOCS), items(spark)).count() == 0
    assert all(r.n_hit == 0 for r in D.report(frame(spark, rows), items(spark, [])).collect())


def test_removal(spark):
    rows = documents()
    docs = with_clashes(frame(spark, rows))
    kept = D.decontaminate(docs, items(spark))
    hit = {r[0] for r in brute(rows, ITEMS) if r[-1]}
    assert hit == {100, 102, 103, 104}
    assert tuples(kept) == sorted((r for r in tuples(docs) if r[0] not in hit), key=repr)
    spans = D.decontaminate(docs, items(spark), remove="spans")
    assert spans.columns == docs.columns and spans.count() == len(rows)
    text = {r.doc_id: r.text for r in spans.collect()}
    assert text[104] == "(and more." and text[103] == ""
    assert text[100] == prose(60, 8) + "! " + prose(61, 5)
    assert all(r[2] == 0 for r in tuples(D.report(spans, items(spark))))
