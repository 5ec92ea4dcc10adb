import math

from pyspark.sql import functions as F

from termite.operators import index as ix
from termite.operators import ranking as rk


def test_postings_vocab_and_idf(spark):
    docs = spark.createDataFrame([(1, "oil price oil"), (2, "price corn")], "doc_id long, text string")
    idx = ix.build_index(docs, stemmer=None)
    post = {(r.term, r.doc_id): r.tf for r in idx.postings.collect()}
    assert post == {("oil", 1): 2, ("price", 1): 1, ("price", 2): 1, ("corn", 2): 1}
    v = {r.term: r for r in idx.vocab.collect()}
    n = 5  # every token is a "document" of the vectoriser
    assert abs(v["oil"].idf - (math.log((1 + n) / (1 + 2)) + 1)) < 1e-12
    assert (v["price"].cf, v["price"].df, v["price"].first_doc, v["price"].first_pos) == (2, 2, 1, 1)


def test_ranking_ties_by_doc_id_and_no_zero_scores(spark):
    # ledger D15: a query matching nothing gives no rows; equal scores by doc_id
    docs = spark.createDataFrame([(2, "oil"), (1, "oil"), (3, "corn")], "doc_id long, text string")
    idx = ix.build_index(docs, stemmer=None)
    q = spark.createDataFrame([(1, "oil"), (2, "nothing here")], "query_id long, text string")
    qt = rk.query_term_counts(rk.query_tokens(q, None))
    r = rk.rank_documents(rk.vsm_scores(idx.postings, idx.vocab, qt)).collect()
    assert [(x.query_id, x.rank, x.doc_id) for x in sorted(r)] == [(1, 1, 1), (1, 2, 2)]


def test_dense_ids_are_dense_and_ordered(spark):
    df = spark.range(0, 1000, 1, 7).select(F.format_string("w%04d", (999 - F.col("id"))).alias("term"))
    got = sorted((r.term_id, r.term) for r in ix.dense_ids(df, "term", "term_id").collect())
    assert [i for i, _ in got] == list(range(1000))
    assert [t for _, t in got] == sorted(t for _, t in got)


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() >= 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_ordinal_within_matches_row_number_on_a_hot_group(spark):
    from pyspark.sql import Window

    # group 0 holds most rows and spans many partitions after the range sort
    df = spark.range(0, 3000, 1, 9).select(
        F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id") % 7).alias("g"),
        ((F.col("id") * 7919) % 101).alias("score"), F.col("id").alias("doc_id"))
    got = ix.ordinal_within(df, "g", [F.col("score").desc(), F.col("doc_id")], "rank")
    w = Window.partitionBy("g").orderBy(F.col("score").desc(), F.col("doc_id"))
    want = df.withColumn("rank", F.row_number().over(w))
    assert sorted(tuple(r) for r in got.select("g", "doc_id", "rank").collect()) == \
        sorted(tuple(r) for r in want.select("g", "doc_id", "rank").collect())
