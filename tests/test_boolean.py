import random

import pytest

from termite.operators import boolean as bl


def _show(n):
    if n.kind == "TERM":
        return n.term
    return (n.kind, *[("not", _show(c)) if out else _show(c) for c, out in n.parts])


def test_trees():
    assert _show(bl.read_query("algorithm AND (data OR structure) OR (comp AND prog)")) == (
        "OR", ("AND", "algorithm", ("OR", "data", "structure")), ("AND", "comp", "prog"))
    # ledger D2: operators are case-insensitive; punctuation is no syntax
    assert _show(bl.read_query("a and b.c!")) == ("AND", "a", "b.c!")
    assert _show(bl.read_query("a AND b AND_NOT c AND d")) == ("AND", "a", "b", ("not", "c"), "d")
    assert _show(bl.read_query("a b AND c")) == ("OR", "a", ("AND", "b", "c"))


def _eval_tree(n, docs):
    """Which documents a tree answers, on Python sets."""
    if n.kind == "TERM":
        return {d for d, terms in docs.items() if n.term in terms}
    held = [_eval_tree(c, docs) for c, out in n.parts if not out]
    if n.kind == "OR":
        return set().union(*held)
    return set.intersection(*held) - set().union(*[_eval_tree(c, docs) for c, out in n.parts if out])


def _random_query(rng, vocab, depth=0):
    if depth > 2 or rng.random() < 0.35:
        t = rng.choice(vocab)
        return t, lambda terms: t in terms
    op = rng.choice(["AND", "OR", "AND_NOT"])
    left = _random_query(rng, vocab, depth + 1)
    right = _random_query(rng, vocab, depth + 1)
    (lq, lf), (rq, rf) = left, right
    holds = {"AND": lambda d: lf(d) and rf(d), "OR": lambda d: lf(d) or rf(d), "AND_NOT": lambda d: lf(d) and not rf(d)}
    return f"( {lq} {op} {rq} )", holds[op]


def test_trees_match_set_algebra_randomised():
    rng = random.Random(7)
    vocab = ["a", "b", "c", "d", "e"]
    for _ in range(300):
        docs = {i: {t for t in vocab if rng.random() < 0.45} for i in range(12)}
        q, holds = _random_query(rng, vocab)
        extra = rng.choice(vocab) if rng.random() < 0.3 else None
        want = {d for d, terms in docs.items() if holds(terms) or extra in terms}
        assert _eval_tree(bl.read_query(f"{q} {extra}" if extra else q), docs) == want, q


def test_equal_precedence_left_associative():
    docs = {1: {"a"}, 2: {"b", "c"}, 3: {"c"}}
    # (a OR b) AND c  -> {2}, not a OR (b AND c)
    assert _eval_tree(bl.read_query("a OR b AND c"), docs) == {2}


def test_queries_on_spark_and_ledger_cases(spark):
    post = spark.createDataFrame(
        [("a1", 1), ("b1", 1), ("a1", 2), ("c1", 2), ("a1", 3), ("datastructure", 3)], "term string, doc_id long")
    groups = " AND ".join(["(a1 OR c1)"] * 20)
    queries = spark.createDataFrame(
        [(1, "a1 AND_NOT b1"),         # D1: last doc holding only a1 is kept
         (2, "a1 and c1"),             # D2: lower-case operator
         (3, "zzz OR c1"),             # D3: unknown term -> empty list
         (4, "zzz AND a1"),
         (5, "( a1 AND"),              # malformed: a status, the batch continues
         (6, "AND"),
         (7, groups),                  # twenty groups are twenty nodes
         (8, "data.structure! AND a1"),  # D17: punctuation is removed
         (9, None),
         (10, "((a1 AND (b1 OR c1)) AND_NOT b1) OR datastructure")],
        "query_id long, query string")
    nodes = bl.parse_queries(queries)
    got = {(r.query_id, r.doc_id) for r in bl.evaluate(post, nodes, bl.operand_terms(nodes, None)).collect()}
    assert got == {(1, 2), (1, 3), (2, 2), (3, 2), (7, 1), (7, 2), (7, 3), (8, 3), (10, 2), (10, 3)}
    assert {r.query_id: r.status for r in bl.rejected_queries(nodes).collect()} == {
        5: "unbalanced (", 6: "operator AND lacks an operand", 9: "no operand"}


def test_misspelt_operands_are_corrected(spark):
    post = spark.createDataFrame([("data", 1), ("structure", 1), ("data", 2)], "term string, doc_id long")
    vocab = spark.createDataFrame([("data", 1, 0), ("structure", 1, 1)], "term string, first_doc long, first_pos long")
    queries = spark.createDataFrame([(1, "dta AND strcture"), (2, "data")], "query_id long, query string")
    assert {tuple(r) for r in bl.retrieve(post, queries, None, vocab).collect()} == {(1, 1), (2, 1), (2, 2)}
    terms = bl.operand_terms(bl.parse_queries(queries), None, vocab)
    assert [tuple(r) for r in bl.suggestions(terms).collect()] == [(1, "data structure")]


def test_set_operators(spark):
    l = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "query_id long, doc_id long")
    r = spark.createDataFrame([(1, 2), (1, 4)], "query_id long, doc_id long")
    ids = lambda df: sorted(x.doc_id for x in df.collect())
    assert ids(bl.bool_and(l, r)) == [2]
    assert ids(bl.bool_or(l, r)) == [1, 2, 3, 4]
    assert ids(bl.bool_and_not(l, r)) == [1, 3]


def test_unbalanced_parenthesis_is_an_error():
    with pytest.raises(ValueError):
        bl.read_query("( a AND b")


def test_random_trees_over_documents(spark):
    """Operands of one or more terms, unknown ones, exclusions, nested groups."""
    rng = random.Random(12)
    vocab = ["aa", "bb", "cc", "dd", "ee", "ff"]
    docs = {i: {t for t in vocab[:5] if rng.random() < 0.5} for i in range(25)}
    post = spark.createDataFrame([(t, d, 1) for d, ts in docs.items() for t in ts], "term string, doc_id long, tf long")
    asked = [_random_query(rng, vocab)[0] for _ in range(60)] + ["aa AND_NOT bb AND_NOT cc", "ff", "aa AND ff", "aa OR ff",
                                                                  "aa.bb AND cc", "aa AND_NOT (bb OR cc)", "(", "aa aa AND aa"]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id long, query string")
    got = {(r.query_id, r.doc_id) for r in bl.retrieve(post, queries, None).collect()}
    want = set()
    for i, q in enumerate(asked):
        try:
            tree = bl.read_query(q.replace("aa.bb", "aabb"))  # punctuation inside a term is deleted
        except ValueError:
            continue
        want |= {(i, d) for d in _eval_tree(tree, docs)}
    assert got == want


def test_feedback_tells_status_and_correction(spark):
    vocab = spark.createDataFrame([("data", 1, 0, 0), ("structure", 1, 0, 1)], "term string, df long, first_doc long, first_pos long")
    queries = spark.createDataFrame([(1, "data AND strucure"), (2, "data OR structure"), (3, "data )"), (4, None)],
                                    "query_id long, query string")
    got = {tuple(r) for r in bl.feedback(queries, vocab, None).collect()}
    assert got == {(1, "ok", "data structure"), (2, "ok", None), (3, "unbalanced )", None), (4, "no operand", None)}


def test_single_terms_are_answered_by_their_postings(spark):
    """No row of a document's terms is made for operands of one term, nor at a level
    of the tree that the units do not stand below."""
    post = spark.createDataFrame([(f"{t}1", d) for d in range(20) for t in "abcde" if (d + ord(t)) % 3], "term string, doc_id long")
    texts = ["a1 OR b1 OR c1 OR zz", "d1", "(a1 AND (b1 OR c1)) OR e1", "a1 AND_NOT b1"]
    held = {}
    for r in post.collect():
        held.setdefault(r.doc_id, set()).add(r.term)
    wants = [lambda h: h & {"a1", "b1", "c1"}, lambda h: "d1" in h, lambda h: "a1" in h and h & {"b1", "c1"} or "e1" in h,
             lambda h: "a1" in h and "b1" not in h]
    for text, want in zip(texts, wants):
        nodes = bl.parse_queries(spark.createDataFrame([(1, text)], "query_id long, query string"))
        found = bl.evaluate(post, nodes, bl.operand_terms(nodes, None))
        assert ("collect_set" in found._jdf.queryExecution().executedPlan().toString()) == ("NOT" in text), text
        rows = [r.doc_id for r in found.collect()]
        assert sorted(rows) == sorted(d for d, h in held.items() if want(h)), text
