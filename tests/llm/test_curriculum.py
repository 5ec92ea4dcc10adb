"""Targets, taken words and training positions."""

import math

from small import DOCS, frame, odd_documents, prose, tuples, with_clashes
from termite.llm import curriculum as C


def documents(sizes):
    return [(100 * k + i, prose(i, n), "en", source, n) for k, (source, ns) in enumerate(sizes) for i, n in enumerate(ns)]


def water_level(sizes, weights):
    """Targets by raising the level in small steps of exact fractions."""
    from fractions import Fraction as Fr

    total, capped = sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        level = Fr(total - sum(3 * sizes[i] for i in capped), sum(weights[i] for i in free))
        more = {i for i in free if 3 * sizes[i] <= level * weights[i]}
        if not more:
            return [float(3 * s if i in capped else level * w) for i, (s, w) in enumerate(zip(sizes, weights))]
        capped |= more


def test_targets_are_met(spark):
    rows = documents([("a", [5] * 4), ("b", [40, 60, 100] * 5), ("c", [300] * 3), ("B", [7, 9]), (None, [50, 50])])
    got = C.mix(frame(spark, rows)).collect()
    # code points: B, a, b, c, null
    want = dict(zip(["B", "a", "b", "c", None], water_level([16, 20, 1000, 900, 100], [5, 2, 1, 5, 2])))
    for source, target in want.items():
        mine = [r for r in got if r.source == source]
        assert {round(r.target, 6) for r in mine} == {round(target, 6)}
        assert sum(r.taken for r in mine) == math.floor(target + 0.5)
        assert all(0 <= r.taken <= 3 * r.size for r in mine)
    assert math.isclose(sum(want.values()), 2036)


def test_slices_do_not_change_the_result(spark, monkeypatch):
    rows = documents([("a", [5, 6, 7, 8] * 10), ("b", [40, 60] * 20)])
    columns = ("doc_id", "size", "source_size", "target", "taken", "position")
    once = tuples(C.mix(frame(spark, rows)), *columns)
    monkeypatch.setattr(C, "SLICE_ROWS", 1)
    assert tuples(C.mix(frame(spark, rows).repartition(7)), *columns) == once


def test_positions_follow_the_schedule(spark):
    rows = documents([("a", [10] * 300), ("b", [10] * 300), ("c", [10] * 300)])
    got = C.readings(frame(spark, rows)).collect()
    position = [r.position for r in got]
    assert position == sorted(position) and 0 <= position[0] and position[-1] <= 1
    for source, slope in (("a", 0.5), ("b", 0.0), ("c", -0.5)):
        mine = [r for r in got if r.source == source]
        target = mine[0].target
        half = sum(len(r.text.split()) for r in mine if r.position < 0.5)
        assert abs(half / target - (0.5 + slope / 4)) < 0.02
        assert abs(sum(len(r.text.split()) for r in mine) - target) <= 1


def test_readings_repeat_and_cut(spark):
    rows = documents([("a", [10, 20]), ("b", [500, 600, 700])])
    got = C.readings(frame(spark, rows)).collect()
    words = {}
    for r in got:
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    taken = {r.doc_id: r.taken for r in C.mix(frame(spark, rows)).collect() if r.taken}
    assert words == taken and taken[0] == 30 and taken[1] == 60  # source a stops at three times its size
    assert {r.reading for r in got if r.doc_id == 0} == {0, 1, 2}


def test_odd_documents_and_clashing_columns(spark):
    rows = odd_documents()
    docs = with_clashes(frame(spark, rows))
    got = C.mix(docs).collect()
    assert len(got) == len(rows)
    assert all(r.taken == 0 and r.position is None for r in got if r.size == 0)
    assert sum(r.size for r in got) == 30_000 + 60 * 2 + 90 * 2 + 5 + 2 + 1  # a no-break space is no white space
    assert {r.source_size for r in got if r.source is None} == {1}
    assert C.readings(docs).where("text is null").count() == 0
    assert C.mix(frame(spark, [], DOCS)).count() == 0
    blank = C.mix(frame(spark, [(1, None, "en", "a", 0), (2, " ", "en", None, 0)])).collect()
    assert [(r.target, r.taken) for r in blank] == [(0.0, 0)] * 2
