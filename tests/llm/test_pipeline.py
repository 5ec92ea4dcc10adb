"""The pipeline's stages against brute-force versions of each decision."""

import hashlib
import math
import random

import corpus_pipeline as P
from small import DOCS, frame, odd_documents, prose, tuples, with_clashes
from test_curriculum import water_level
from test_decontaminate import brute as brute_hits
from test_ngram_join import brute as brute_components
from test_quality import brute as brute_quality
from test_substring_dedup import brute as brute_repeats
from termite.llm.substring_dedup import WORD

BENCHMARK = [(1, prose(900, 30)), (2, prose(901, 12)), (3, None)]


def documents():
    rng = random.Random(9)
    passage, rows = prose(800, 60), []
    for i in range(70):
        text = prose(i, 50 + i, 5000)
        if i % 10 == 3:
            text = text + "\n" + passage
        if i % 14 == 5:
            text = prose(i, 20) + " " + prose(900, 30) + " " + text
        rows.append((i, text, "en", f"s{i % 5}" if i % 6 else None, len(text)))
    rows += [(100 + i, rows[i][1] + (" end" if i % 2 else ""), "en", "s0", len(rows[i][1])) for i in range(0, 40, 4)]
    rows += [(200 + i, "too short", "en", "s1", 9) for i in range(4)] + [(300, "over and over again " * 40, "en", "s1", 800)]
    rng.shuffle(rows)
    return rows


def brute_stages(rows):
    """Rows that each of the first four stages leaves."""
    out = [[r for r in rows if brute_quality(r[1])[-1]]]
    least = {r[0]: r[2] for r in brute_components(out[-1])}
    out.append([r for r in out[-1] if least[r[0]] == r[0]])
    gone = {r[0]: r[3] for r in brute_repeats(out[-1], 35)}
    out.append([(r[0], gone[r[0]], *r[2:4]) for r in out[-1]])
    return out


def words(text):
    import hashlib

    return hashlib.sha256(b" ".join(WORD.findall((text or "").encode()))).hexdigest()


def test_stages_one_by_one(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame(BENCHMARK, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    rows = documents()
    docs = with_clashes(frame(spark, rows))
    want = brute_stages(rows)
    results = []
    for (_, stage), name in zip(P.STAGES, "abcde"):
        stage(spark, docs, sf).write.parquet(f"{sf}/{name}")
        results.append(docs := spark.read.parquet(f"{sf}/{name}"))
        if name != "e":
            assert docs.columns == results[0].columns == with_clashes(frame(spark, rows)).columns
    assert tuples(results[0], *DOCS.names) == sorted(want[0], key=repr)
    assert tuples(results[1], *DOCS.names) == sorted(want[1], key=repr)
    cut = [(r.doc_id, words(r.text), r.lang, r.source) for r in results[2].collect()]
    assert sorted(cut, key=repr) == sorted(want[2], key=repr)
    assert all(r.n_chars == len(r.text) for r in results[2].collect())
    third = [tuple(r) for r in results[2].select(*DOCS.names).collect()]
    clean = {r[0] for r in brute_hits(third, BENCHMARK) if not r[-1]}
    assert len(clean) < len(third)
    assert tuples(results[3], *DOCS.names) == sorted((r for r in third if r[0] in clean), key=repr)
    size = {r.doc_id: len(WORD.findall(r.text.encode())) for r in results[3].collect()}
    mixed = results[4].collect()
    assert {r.doc_id for r in mixed} <= clean
    assert abs(sum(len(WORD.findall(r.text.encode())) for r in mixed) - sum(size.values())) <= 6
    assert {r.source: r.source_size for r in mixed} == {
        s: sum(size[r[0]] for r in third if r[3] == s and r[0] in clean) for s in {r.source for r in mixed}}


def test_run(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame(BENCHMARK, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    frame(spark, documents()).write.parquet(f"{sf}/documents.parquet")
    got = P.run(spark, sf)
    assert got.count() > 0 and set(DOCS.names) < set(got.columns)
    assert tuples(P.run(spark, sf)) == tuples(got)


def test_odd_documents_and_empty_tables(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame(BENCHMARK, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for rows in (odd_documents(), []):
        for _, stage in P.STAGES:
            out = stage(spark, with_clashes(frame(spark, rows)), sf)
            assert out.count() <= 3 * len(rows)


def brute_mix(rows):
    """Rows of the last stage: each reading of each document."""
    size = {r[0]: len(WORD.findall((r[1] or "").encode())) for r in rows}
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    total = [sum(size[r[0]] for r in rows if r[3] == s) for s in sources]
    out = []
    for k, (s, whole, target) in enumerate(zip(sources, total, water_level(total, [(5, 2, 1)[i % 3] for i in range(len(total))]))):
        slope, start, words = (0.5, 0.0, -0.5)[k % 3], 0, math.floor(target + 0.5)
        mine = sorted((r for r in rows if r[3] == s), key=lambda r: (hashlib.md5(str(r[0]).encode()).hexdigest(), r[0]))
        for r in mine:
            n, times = size[r[0]], words // whole
            rest = max(0, min(n, words - times * whole - start))
            for reading in range(times + (rest > 0)):
                q = min(1.0, (start + reading * whole) / target)
                position = 2 * q / (1 + slope + math.sqrt(max(0.0, (1 + slope) ** 2 - 4 * slope * q)))
                text = b" ".join(WORD.findall(r[1].encode())[:rest]).decode() if reading == times and rest < n else r[1]
                out.append((r[0], text, s, n, whole, times * n + rest, reading, round(target, 6), round(position, 9)))
            start += n
    return sorted(out, key=repr)


def test_every_row_of_run(spark, tmp_path, monkeypatch):
    """The first four stages by brute force, and each row of the last from what the fourth wrote."""
    sf = str(tmp_path)
    spark.createDataFrame(BENCHMARK, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    frame(spark, documents()).write.parquet(f"{sf}/documents.parquet")
    monkeypatch.setattr(P, "scratch_path", lambda _, name: f"{sf}/{name}")
    got = [(r.doc_id, r.text, r.source, r.size, r.source_size, r.taken, r.reading, round(r.target, 6), round(r.position, 9))
           for r in P.run(spark, sf).collect()]
    third, fourth = ([tuple(r) for r in spark.read.parquet(f"{sf}/{n}").select(*DOCS.names).collect()]
                     for n in ("substring-dedup", "benchmark-decontamination"))
    assert sorted(((r[0], words(r[1]), *r[2:4]) for r in third), key=repr) == sorted(brute_stages(documents())[2], key=repr)
    clean = {r[0] for r in brute_hits(third, BENCHMARK) if not r[-1]}
    assert sorted(fourth, key=repr) == sorted((r for r in third if r[0] in clean), key=repr)
    assert sorted(got, key=repr) == brute_mix(fourth)
