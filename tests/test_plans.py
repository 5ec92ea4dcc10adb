"""Plan assertions on the driver tables (sf0.001): broadcasts where the small
side was checked, column pruning at the scan, no cartesian products."""

from termite.plans import catalog as C

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranked_search_broadcasts_query_terms_and_prunes_columns(spark):
    p = plan(C.REGISTRY["vsm_score"](spark, SF))
    assert "BroadcastHashJoin" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    # the search reads the stored postings, four columns of them, and no text
    assert "ReadSchema: struct<term:string,doc_id:bigint,tf:bigint,size_class:int>" in p and "text" not in p


def test_index_reads_two_columns_of_the_documents(spark):
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan(C.REGISTRY["explode_tokens"](spark, SF))


def test_search_in_one_corpus_reads_its_partition(spark, monkeypatch):
    import re

    from termite.operators import stored_index as si

    index = si.write_index(C._corpora(spark, SF), corpus_col="corpus", buckets=2)
    seen, best = [], si._best
    monkeypatch.setattr(si, "_best", lambda postings, *a: seen.append(plan(postings)) or best(postings, *a))
    si.search(index, C.benchmark_terms(spark, SF), corpus="course")
    assert seen and all(re.search(r"PartitionFilters: \[[^]]*corpus#\d+ = course", p) for p in seen)


def test_boolean_plan_has_no_cartesian_product(spark):
    p = plan(C.REGISTRY["boolean_retrieval"](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_knn_and_thesaurus_plans_have_no_cartesian_product(spark):
    for name in ("knn_topic_classifier", "build_thesaurus", "bigram_model"):
        p = plan(C.REGISTRY[name](spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_top_k_is_limited_before_the_shuffle(spark):
    p = plan(C.REGISTRY["vsm_score"](spark, SF))
    assert "WindowGroupLimit" in p


def test_boolean_search_keeps_five_documents_a_query_before_the_shuffle(spark):
    from termite.operators import boolean as bl

    hits = C.REGISTRY["bool_or"](spark, SF)
    assert "WindowGroupLimit" in plan(bl.first_documents(hits, 5))
    # the levels of all trees are folded where the documents' postings lie
    assert "Exchange hashpartitioning(query_id" not in plan(hits)


def test_binarise_counts_where_the_postings_lie(spark):
    from termite.operators import index as ix

    p = plan(C.REGISTRY["binarise"](spark, SF))
    assert "hashpartitioning(doc_id" not in p and "regexp_extract_all" not in p
    tokens = C.corpus_index(spark, SF).tokens
    want = tokens.join(ix.top_terms(tokens).select("term"), "term").select("doc_id", "term").distinct()
    got = C.REGISTRY["binarise"](spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted((r.doc_id, r.term, 1) for r in want.collect())
