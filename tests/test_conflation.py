"""Lemma and Porter chain through index, ranked and Boolean search."""

import random
import re

import pytest

from termite.functions import constants as K
from termite.functions.stemming import porter_stem
from termite.operators import boolean as bl
from termite.operators import conflation as cf
from termite.operators import index as ix
from termite.operators import ranking as rk
from termite.operators import stored_index as si

WORDS = ("connections connected connecting relational relations the and of cities city running ran probes probing probe "
         "knives knife generously generalisation generals x s is hopping hopefully sized s's").split()
LEMMAS = {"knives": "knife", "cities": "city", "ran": "run", "generals": "the"}


def brute(text, lemmas, porter):
    words = re.findall(r"[a-z0-9_]{2,}", re.sub(r"[^\w\s]", "", (text or "").lower()))
    out = []
    for w in words:
        w = lemmas.get(w, w)
        w = porter_stem(w) if porter else w
        if len(w) >= 2 and w not in K.stop_words():
            out.append(w)
    return out


def texts(n, seed):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(WORDS) + rng.choice(["", ",", "."]) for _ in range(rng.randrange(12)))) for i in range(n)] + [(n, None)]


@pytest.mark.parametrize("porter", [True, False])
@pytest.mark.parametrize("broadcast", [True, False])
def test_chain_against_a_plain_version(spark, monkeypatch, porter, broadcast):
    if not broadcast:  # a few hot terms by broadcast, the rest by a shuffle
        monkeypatch.setattr(cf, "MAX_BROADCAST_BYTES", 0)
        monkeypatch.setattr(cf, "HOT_TERM", 12)
    rows = texts(60, 3)
    lemmas = spark.createDataFrame(list(LEMMAS.items()), "term string, lemma string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = cf.term_arrays(docs, "doc_id", "text", cf.Conflation(lemmas, porter)).collect()
    assert {r.doc_id: list(r.terms) for r in got} == {i: brute(t, LEMMAS, porter) for i, t in rows}


def test_porter_through_index_ranked_and_boolean_search(spark):
    docs = spark.createDataFrame([(1, "Connected cities"), (2, "A connection of the city"), (3, "Running probes"), (4, "probing")],
                                 "doc_id long, text string")
    assert {r.term for r in ix.token_table(docs, stemmer="porter").collect()} == {"connect", "citi", "run", "probe"}
    index = si.write_index(docs, stemmer="porter", buckets=2)
    queries = spark.createDataFrame([(1, "connecting"), (2, "probe CITY")], "query_id long, text string")
    found = si.search(index, rk.query_term_counts(rk.query_tokens(queries, "porter"))).collect()
    assert {(r.query_id, r.doc_id) for r in found} == {(1, 1), (1, 2), (2, 1), (2, 2), (2, 3), (2, 4)}
    asked = spark.createDataFrame([(1, "connections AND_NOT of"), (2, "cities AND connect"), (3, "ran OR probed")],
                                  "query_id long, query string")
    hits = bl.retrieve(index.postings, asked, "porter").collect()
    assert {(r.query_id, r.doc_id) for r in hits} == {(1, 1), (1, 2), (2, 1), (2, 2), (3, 3), (3, 4)}


def exchanges(df, of: str) -> int:
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0].count(f"Exchange hashpartitioning({of}")


@pytest.mark.parametrize("limit", [1 << 27, 1300, 300])
def test_tokens_travel_once_to_their_document(spark, monkeypatch, limit):
    """All changed terms broadcast; the frequent terms; fewer of these.  Repeated and
    missing ids keep their meaning."""
    monkeypatch.setattr(cf, "MAX_BROADCAST_BYTES", limit)
    rows = texts(80, 5)
    lemmas = spark.createDataFrame(list(LEMMAS.items()), "term string, lemma string")
    docs = spark.createDataFrame(rows + rows[:3] + [(None, "probes running")], "doc_id long, text string")
    got = cf.term_arrays(docs, "doc_id", "text", cf.Conflation(lemmas), parts=3)
    if limit == 1 << 27:
        assert exchanges(got.repartition(3, "doc_id"), "doc_id") == 1 and exchanges(got, "term") == 0
    want = {i: brute(t, LEMMAS, True) for i, t in rows}
    found = {r.doc_id: list(r.terms) for r in got.collect()}
    assert found.pop(None) == []
    assert {i: sorted(v) for i, v in found.items()} == {i: sorted(w * (1 + (i < 3))) for i, w in want.items()}
    assert all(found[i] == w for i, w in want.items() if i >= 3)


def test_frequent_terms_are_broadcast_as_far_as_they_fit(spark, monkeypatch):
    forms = spark.createDataFrame([("aa", 1, "aa"), ("bb", 9, "bb"), ("cc", 70, None), ("dd", 300, "dd")], "term string, cf long, form string")
    for limit, above in ((0, cf.HOT_TERM), (28, 255), (54, 63), (82, 7), (200, 0)):
        monkeypatch.setattr(cf, "MAX_BROADCAST_BYTES", limit)
        assert cf.hot_above(forms) == above, limit
