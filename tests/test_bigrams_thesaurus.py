import random
from collections import Counter

from pyspark.sql import functions as F

from termite.operators import bigrams as bg
from termite.operators import index as ix
from termite.operators import thesaurus as th


def test_adjacent_pairs_cross_documents_and_buckets(spark):
    # documents of 0, 1 and 2+ tokens, near and far ids, over several ranges
    rows = [(0, ["a", "b"]), (3, []), (4, ["c"]), (9, ["d", "e", "f"]), (10, ["g"]), (25, []),
            (-(1 << 60), ["h"]), (1 << 61, ["i", "j"]), ((1 << 61) + 1, ["k"])]
    arrays = spark.createDataFrame(rows, "doc_id long, toks array<string>")
    stream = [t for _, toks in sorted(rows) for t in toks]
    want = Counter(zip(stream, stream[1:]))
    for partitions in (1, 2, 4, 7, None):
        pairs = bg.adjacent_pairs(arrays, partitions=partitions)
        got = Counter((r.w1, r.w2) for r in pairs.collect())
        assert got == want, partitions
    inner = bg.adjacent_pairs(arrays, within_document=True)
    assert Counter((r.w1, r.w2) for r in inner.collect()) == Counter([("a", "b"), ("d", "e"), ("e", "f"), ("i", "j")])


def test_similarity_example(spark):
    # x in docs {1,2,3}, y in {2,3,4,5}: 2 shared / max(3, 4) = 0.5 both ways
    toks = [(d, 0, "x") for d in (1, 2, 3)] + [(d, 1, "y") for d in (2, 3, 4, 5)]
    tokens = spark.createDataFrame(toks, "doc_id long, pos long, term string")
    got = {(r.term, r.related): r.sim for r in th.cooccurrence_similarity(tokens, min_cf=0).collect()}
    assert got == {("x", "y"): 0.5, ("y", "x"): 0.5}


def _brute_cooc(docs):
    c = Counter()
    for terms in docs.values():
        ts = sorted(set(terms))
        for i, a in enumerate(ts):
            for b in ts[i + 1:]:
                c[(a, b)] += 1
    return c


def test_tiled_cooccurrence_matches_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"t{i:02d}" for i in range(37)]
    docs = {d: rng.sample(vocab, rng.randint(0, 12)) for d in range(60)}
    toks = [(d, p, t) for d, ts in docs.items() for p, t in enumerate(ts)]
    tokens = spark.createDataFrame(toks, "doc_id long, pos long, term string")
    post = ix.postings(tokens)
    vocab = ix.vocabulary(post)
    ids = th.top_term_ids(vocab, 0)
    sets = th.doc_term_sets(post, ids)
    names = {r.tid: r.term for r in ids.collect()}
    want = _brute_cooc(docs)
    df = Counter(t for ts in docs.values() for t in ts)
    assert [df[names[i]] for i in range(len(names))] == sorted(df.values(), reverse=True)
    for tile, chunk in ((5, 7), (5, 20_000), (1024, 20_000)):  # many chunks and tiles, many tiles, one of each
        pairs = th.cooccurrence_counts(sets, chunk, tile)
        got = Counter({tuple(sorted((names[r.i], names[r.j]))): r.co for r in pairs.collect()})
        assert got == want, tile
        both = {(a, b): co / max(df[a], df[b]) for (x, y), co in want.items() for a, b in ((x, y), (y, x))}
        for min_sim in (None, 0.45):
            for asked in (None, ["t03", "t11", "t30", "zz"]):
                rows = th.similar_terms(post, vocab, 0, min_sim, asked and spark.createDataFrame([(a,) for a in asked], "term string"),
                                        chunk, tile).collect()
                assert {(r.term, r.related): r.sim for r in rows} == {
                    k: v for k, v in both.items() if v >= (min_sim or 0) and (asked is None or k[0] in asked)}
                assert len(rows) == len({(r.term, r.related) for r in rows})


def test_best_related_excludes_self_on_ties(spark):
    # ledger D18: two terms with sim 1.0; the pick is never the term itself
    thes = spark.createDataFrame(
        [("a", "a", 1.0), ("a", "b", 1.0), ("a", "c", 1.0), ("b", "a", 1.0)],
        "term string, related string, sim double")
    got = {r.term: r.related for r in th.top_related(thes, 1).collect()}
    assert got == {"a": "b", "b": "a"}


def test_hashed_ids_give_the_pairs_of_their_order(spark):
    """One row a partition is all that the window over all rows sees."""
    rng = random.Random(6)
    ids = sorted(rng.getrandbits(63) - (1 << 62) for _ in range(300))
    rows = [(i, [rng.choice("abcdef") for _ in range(rng.randrange(4))]) for i in ids]
    stream = [t for _, toks in rows for t in toks]
    arrays = spark.createDataFrame(rows, "doc_id long, toks array<string>").repartition(5)
    pairs = bg.adjacent_pairs(arrays, partitions=6)
    assert Counter((r.w1, r.w2) for r in pairs.collect()) == Counter(zip(stream, stream[1:]))
    sizes = []
    real = bg.stored
    bg.stored = lambda df, name: sizes.append((name, real(df, name))) or sizes[-1][1]
    try:
        bg.adjacent_pairs(arrays, partitions=6)
    finally:
        bg.stored = real
    assert dict(sizes)["document-ends"].select("part").distinct().count() == 6


def test_nested_successors_come_in_pieces(spark):
    rng = random.Random(4)
    counts = [(a, f"w{i:03d}", rng.randrange(1, 9)) for a, n in (("the", 50), ("of", 10), ("x", 1)) for i in range(n)]
    df = spark.createDataFrame(counts, "w1 string, w2 string, cnt long")
    nested = bg.bigram_nested(df, 7)
    assert {(r.w1, r.piece): len(r.successors) for r in nested.collect()} == {
        **{("the", i): 7 for i in range(7)}, ("the", 7): 1, ("of", 0): 7, ("of", 1): 3, ("x", 0): 1}
    got = [tuple(r) for r in bg.successors_of(nested, 7).orderBy("w1", "place").collect()]
    want = []
    for a in ("of", "the", "x"):
        mine = sorted(((w, c) for x, w, c in counts if x == a), key=lambda x: (-x[1], x[0]))
        want += [(a, i, w, c) for i, (w, c) in enumerate(mine, 1)]
    assert got == want


def test_best_rows_of_a_term_leave_the_tasks_alone(spark):
    """Pairs are counted in one task each, and a task gives the best rows of a term only."""
    rng = random.Random(12)
    post = spark.createDataFrame(sorted({(f"t{int(rng.paretovariate(0.7)) % 60:02d}", d) for d in range(300) for _ in range(12)}),
                                 "term string, doc_id long").withColumn("tf", F.lit(1).cast("long")).withColumn("first_pos", F.lit(0))
    vocab = ix.vocabulary(post)
    whole = th.similar_terms(post, vocab, 0)
    some = th.similar_terms(post, vocab, 0, best=2, tile=16, chunk=40)
    want = sorted(map(tuple, th.top_related(whole, 2).collect()))
    assert sorted(map(tuple, th.top_related(some, 2).collect())) == want
    assert some.count() < whole.count() / 2
    counts = th.cooccurrence_counts(th.doc_term_sets(post, th.top_term_ids(vocab, 0)), 40, 16)
    assert "HashAggregate" not in counts._jdf.queryExecution().executedPlan().toString()


def test_bands_are_bounded_by_postings_and_terms():
    bands = th.term_bands([(50, 2), (10, 7), (1, 100)], 40, 60)
    assert [b[0] for b in bands] == [sum(x[1] for x in bands[:i]) for i in range(len(bands))]
    assert sum(b[1] for b in bands) == 109 and max(b[1] for b in bands) <= 40
    assert bands[:3] == [(0, 1, 50, 50), (1, 2, 50, 10), (3, 6, 10, 10)]


def test_two_bands_meet_in_one_task():
    """Also for rows of both directions; asked terms of few postings share a task."""
    bands = [(0, 1, 50, 50), (1, 2, 50, 10), (3, 6, 10, 10), (9, 30, 10, 1)]
    met = [{*lefts, b} for lefts, b in th.band_tasks(bands, 0.0, None, 60)]
    assert len(met) == 10 and all({a, b} in met for a in range(4) for b in range(4))
    assert {(a, b) for lefts, b in th.band_tasks(bands, 0.5, None, 60) for a in lefts} == {
        (0, 0), (0, 1), (1, 1), (1, 2), (2, 2), (1, 3), (2, 3), (3, 3)}
    few = th.band_tasks(bands, 0.0, {0: 40, 2: 20, 3: 5}, 60)
    assert few == [(lefts, b) for b in range(4) for lefts in ([0, 2], [3])]


def test_bands_of_all_pairs_are_bounded_by_what_their_task_gives():
    assert th.band_postings(50_000) < 2 << 20
    assert th.band_postings(1 << 62) == th.BAND_POSTINGS


def test_both_directions_of_all_pairs_leave_the_task(spark, monkeypatch):
    rng = random.Random(5)
    post = spark.createDataFrame(sorted({(f"t{int(rng.paretovariate(0.7)) % 50:02d}", d) for d in range(200) for _ in range(9)}),
                                 "term string, doc_id long").withColumn("tf", F.lit(1).cast("long")).withColumn("first_pos", F.lit(0))
    vocab = ix.vocabulary(post)
    docs = {}
    for r in post.collect():
        docs.setdefault(r.doc_id, []).append(r.term)
    want = _brute_cooc(docs)
    monkeypatch.setattr(th, "LEAST_POSTINGS", 1)
    both = th.similar_terms(post, vocab, 0, tile=9, chunk=30)
    assert "Generate" not in both._jdf.queryExecution().executedPlan().toString()
    rows = both.collect()
    assert sorted((r.term, r.related, r.co) for r in rows) == sorted(x for (a, b), co in want.items() for x in ((a, b, co), (b, a, co)))
    once = th.similar_terms(post, vocab, 0, tile=9, chunk=30, once=True).collect()
    assert sorted((r.term, r.related, r.co) for r in once) == sorted((a, b, co) for (a, b), co in want.items())
    asked = spark.createDataFrame([("t01",), ("t07",), ("t33",)], "term string")
    for n in (1, 3):
        best = th.top_related(th.similar_terms(post, vocab, 0, tile=9, chunk=30, best=n), n).collect()
        assert sorted(map(tuple, best)) == sorted(map(tuple, th.top_related(both, n).collect()))
        some = th.top_related(th.similar_terms(post, vocab, 0, asked=asked, tile=9, chunk=30, best=n), n).collect()
        assert sorted(map(tuple, some)) == sorted(tuple(r) for r in best if r.term in ("t01", "t07", "t33"))
