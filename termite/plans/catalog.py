"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator id of the survey's inventory, each over the whole driver tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termite.operators import conflation as cf
from termite.operators import index as ix
from termite.functions import constants as K
from termite.operators import ranking as rk
from termite.operators import stored_index as si
from termite.session import ship_package, stored
from termite.sources.tables import query_table, read_table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        REGISTRY[name] = run
        return fn
    return deco


_STORED: dict[tuple, si.StoredIndex] = {}


def stored_index(spark: SparkSession, sf_dir: str, stemmer: str | None = "s") -> si.StoredIndex:
    """The index of ``documents``: written by the first query of an application
    that needs it, read by all later ones.  The tables below ``sf_dir`` must not
    change meanwhile."""
    key = (spark.sparkContext.applicationId, sf_dir, stemmer)
    if key not in _STORED:
        _STORED[key] = si.write_index(read_table(spark, sf_dir, "documents", "doc_id", "text"), "text", stemmer)
    return _STORED[key]


def corpus_index(spark: SparkSession, sf_dir: str, stemmer: str | None = "s") -> ix.Index:
    """The token table of ``documents`` (computed where it is used) beside the
    stored postings and vocabulary."""
    index = stored_index(spark, sf_dir, stemmer)
    tokens = ix.token_table(read_table(spark, sf_dir, "documents", "doc_id", "text"), "text", stemmer)
    return ix.Index(tokens, index.postings, index.vocab)


# --- minimum slice ------------------------------------------------------------

def benchmark_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rk.query_term_counts(rk.query_tokens(query_table(spark, sf_dir, "benchmark")))


@register("vsm_score")
def q_vsm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 + W1 + W2: benchmark items as queries, top 5 documents each."""
    return si.search(stored_index(spark, sf_dir), benchmark_terms(spark, sf_dir))


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    from termite.sources.tables import news_documents

    return news_documents(spark, sf_dir)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", "doc_id", "text")


# --- index operators (A1-A7, A10, F5, F7, W9, J1, J2) ---------------------------------

@register("explode_tokens")
def q_explode_tokens(spark, sf_dir):
    """the long token table (doc_id, pos, term)."""
    return corpus_index(spark, sf_dir).tokens


@register("term_frequency")
def q_term_frequency(spark, sf_dir):
    return ix.term_frequency(corpus_index(spark, sf_dir).tokens)


@register("distinct_terms")
def q_distinct_terms(spark, sf_dir):
    return ix.corpus_stats(corpus_index(spark, sf_dir).tokens)


@register("filter_top_terms")
def q_filter_top_terms(spark, sf_dir):
    return ix.top_terms(corpus_index(spark, sf_dir).tokens)


@register("top_terms")
def q_top_terms(spark, sf_dir):
    """A3: terms with cf > 100, most frequent first (a distributed range sort)."""
    t = ix.top_terms(corpus_index(spark, sf_dir).tokens)
    return t.orderBy(F.col("cf").desc(), F.col("term"))


@register("most_common")
def q_most_common(spark, sf_dir):
    """The 20 most common terms."""
    return ix.most_common(corpus_index(spark, sf_dir).tokens, 20)


@register("build_dictionary")
def q_build_dictionary(spark, sf_dir):
    return ix.build_dictionary(corpus_index(spark, sf_dir).vocab)


@register("build_inverted_index")
def q_build_inverted_index(spark, sf_dir):
    return corpus_index(spark, sf_dir).postings.select("term", "doc_id", "tf")


@register("collection_idf")
def q_collection_idf(spark, sf_dir):
    v = corpus_index(spark, sf_dir).vocab
    return v.select("term", "cf", "df", F.round("idf", 6).alias("idf"))


@register("term_weight_matrix")
def q_term_weight_matrix(spark, sf_dir):
    idx = corpus_index(spark, sf_dir)
    return ix.term_weights(idx.postings, idx.vocab)


@register("distinct_terms_per_row")
def q_distinct_terms_per_row(spark, sf_dir):
    return ix.distinct_terms_per_doc(corpus_index(spark, sf_dir).postings)


@register("postings_lookup")
def q_postings_lookup(spark, sf_dir):
    """Each benchmark query term -> its documents (unknown term: no rows)."""
    from termite.plans.sizing import broadcast_if_small

    idx = corpus_index(spark, sf_dir)
    qt = broadcast_if_small(benchmark_terms(spark, sf_dir).select("query_id", "term"))
    return idx.postings.join(qt, "term").select("query_id", "term", "doc_id", "tf")


@register("fetch_documents")
def q_fetch_documents(spark, sf_dir):
    """Ranked results joined to their document rows (name)."""
    top = q_vsm_score(spark, sf_dir)
    return top.join(news(spark, sf_dir).select("doc_id", "name"), "doc_id").select(
        "query_id", "rank", "doc_id", "name")


# --- scalar text functions (P1-P9, P12-P18) ------------------------------------------

from termite.functions import text as tx  # noqa: E402


def _doc_map(spark, sf_dir, expr, src="text"):
    d = news(spark, sf_dir)
    return d.select("doc_id", expr(F.col(src)).alias("out"))


@register("concat_fields")
def q_concat_fields(spark, sf_dir):
    d = news(spark, sf_dir)
    return d.select("doc_id", tx.concat_fields("name", "description").alias("out"))


@register("strip_punctuation")
def q_strip_punctuation(spark, sf_dir):
    return _doc_map(spark, sf_dir, tx.strip_punctuation)


@register("strip_digits")
def q_strip_digits(spark, sf_dir):
    return _doc_map(spark, sf_dir, tx.strip_digits)


@register("non_alnum_to_space")
def q_non_alnum_to_space(spark, sf_dir):
    return _doc_map(spark, sf_dir, tx.non_alnum_to_space)


@register("collapse_whitespace")
def q_collapse_whitespace(spark, sf_dir):
    return _doc_map(spark, sf_dir, tx.collapse_whitespace)


@register("fold_case")
def q_fold_case(spark, sf_dir):
    return _doc_map(spark, sf_dir, tx.fold_case)


@register("strip_parenthesised")
def q_strip_parenthesised(spark, sf_dir):
    return _doc_map(spark, sf_dir, tx.strip_parenthesised)


@register("fill_missing")
def q_fill_missing(spark, sf_dir):
    """NULL kept inside, sentinel only at output."""
    d = news(spark, sf_dir)
    return d.select("doc_id", F.coalesce("description", F.lit("NaN")).alias("description"),
                    F.coalesce(F.array_join("topics", " "), F.lit("NaN")).alias("topic"))


@register("tokenise")
def q_tokenise(spark, sf_dir):
    t = tx.tokenize(tx.strip_punctuation(tx.fold_case(F.col("text"))))
    return _docs(spark, sf_dir).select("doc_id", F.array_join(t, " ").alias("tokens"),
                                       F.size(t).alias("n_tokens"))


@register("remove_stopwords")
def q_remove_stopwords(spark, sf_dir):
    t = tx.remove_stopwords(tx.tokenize(tx.strip_punctuation(tx.fold_case(F.col("text")))))
    return _docs(spark, sf_dir).select("doc_id", F.array_join(t, " ").alias("tokens"),
                                       F.size(t).alias("n_tokens"))


@register("normalise_documents")
def q_normalise_documents(spark, sf_dir):
    t = tx.normalise(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.array_join(t, " ").alias("tokens"),
                                       F.size(t).alias("n_tokens"))


@register("normalise_for_bigrams")
def q_normalise_for_bigrams(spark, sf_dir):
    d = news(spark, sf_dir).where(F.col("description").isNotNull())
    t = tx.normalise_for_bigrams(F.col("description"))
    return d.select("doc_id", F.array_join(t, " ").alias("tokens"), F.size(t).alias("n_tokens"))


@register("edit_distance")
def q_edit_distance(spark, sf_dir):
    """Distance of every unstemmed vocabulary term to its S-stem."""
    from termite.functions.stemming import s_stem

    raw = corpus_index(spark, sf_dir, stemmer=None).vocab.select("term")
    st = raw.select("term", s_stem(F.col("term")).alias("stem"))
    return st.select("term", "stem", tx.edit_distance("term", "stem").alias("dist"))


@register("set_jaccard")
def q_set_jaccard(spark, sf_dir):
    """Jaccard similarity of the word sets of consecutive conversation turns."""
    from pyspark.sql import Window

    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = c.withColumn("prev", F.lag("text").over(w)).where(F.col("prev").isNotNull())
    return c.select("conv_id", "turn", tx.set_jaccard("prev", "text").alias("jaccard"))


@register("count_term_in_list")
def q_count_term_in_list(spark, sf_dir):
    """Occurrences of the corpus' most frequent term in every document
    (0 for documents without it)."""
    idx = corpus_index(spark, sf_dir)
    top = ix.most_common(idx.tokens, 1).select("term").scalar()
    hits = idx.tokens.where(F.col("term") == top).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("cnt"))
    d = _docs(spark, sf_dir).select("doc_id")
    return d.join(hits, "doc_id", "left").select("doc_id", F.coalesce("cnt", F.lit(0)).alias("cnt"))


@register("binarise")
def q_binarise(spark, sf_dir):
    """P15 over the doc x top-term count table (sparse: present rows only)."""
    from termite.operators.features import feature_counts

    idx = corpus_index(spark, sf_dir)
    fc = feature_counts(idx.postings, ix.top_terms(idx.postings))
    return fc.select("doc_id", "term", tx.binarise("cnt").alias("present"))


# --- Boolean retrieval (B1-B3, B6, C2) -----------------------------------------------

from termite.operators import boolean as bl  # noqa: E402

SENTENCE_SPLIT = "[.!?\\n]+"


def without_middle(t: F.Column) -> F.Column:
    """A typing error: the term without its middle character."""
    half = F.floor(F.length(t) / 2).cast("int")
    return F.concat(t.substr(F.lit(1), half), t.substr(half + 2, F.length(t)))


def benchmark_boolean_queries(spark, sf_dir) -> DataFrame:
    """One Boolean query per benchmark item, written in the query language: every
    sentence becomes ``(t1 AND t2 ...)`` over its terms, the first misspelt, and the
    sentences are OR-ed - documents that contain some sentence of the item."""
    b = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    sents = F.transform(F.split(F.col("text"), SENTENCE_SPLIT), lambda s: tx.normalise(s))
    sents = F.filter(sents, lambda a: F.size(a) > 0)
    sents = F.transform(sents, lambda a: F.transform(a, lambda t, i: F.when(i == 0, without_middle(t)).otherwise(t)))
    clauses = F.transform(sents, lambda a: F.concat(F.lit("("), F.array_join(a, " AND "), F.lit(")")))
    return b.select(F.col("item_id").alias("query_id"), F.array_join(clauses, " OR ").alias("query"))


def item_query(spark, sf_dir, operator: str) -> DataFrame:
    """One query per benchmark item over all its terms."""
    qt = rk.query_tokens(query_table(spark, sf_dir, "benchmark"))
    return qt.groupBy("query_id").agg(F.array_join(F.array_sort(F.collect_set("term")), f" {operator} ").alias("query"))


@register("boolean_retrieval")
def q_boolean_retrieval(spark, sf_dir):
    """Parsed Boolean queries with misspelt operands -> matching documents."""
    idx = corpus_index(spark, sf_dir)
    return bl.retrieve(idx.postings, benchmark_boolean_queries(spark, sf_dir), vocab=idx.vocab)


@register("bool_and")
def q_bool_and(spark, sf_dir):
    """B1: documents holding every term of a benchmark item."""
    index = stored_index(spark, sf_dir)
    return bl.retrieve(index.postings, item_query(spark, sf_dir, "AND"))


@register("bool_or")
def q_bool_or(spark, sf_dir):
    """B2: documents holding any term of a benchmark item."""
    index = stored_index(spark, sf_dir)
    return bl.retrieve(index.postings, item_query(spark, sf_dir, "OR"))


@register("bool_and_not")
def q_bool_and_not(spark, sf_dir):
    """Documents holding a whole sentence of an item (B6) AND_NOT every
    term of the item (B1): partial copies of a benchmark item."""
    return bl.bool_and_not(q_boolean_retrieval(spark, sf_dir), q_bool_and(spark, sf_dir))


@register("boolean_search")
def q_boolean_search(spark, sf_dir):
    """B6 + fetch (J1); first 5 documents by doc_id with their name."""
    top = bl.first_documents(q_boolean_retrieval(spark, sf_dir), 5)
    return top.join(news(spark, sf_dir).select("doc_id", "name"), "doc_id").select(
        "query_id", "rank", "doc_id", "name")


@register("boolean_feedback")
def q_boolean_feedback(spark, sf_dir):
    """C5 for Boolean queries: status and "did you mean" of every benchmark query;
    those of every seventh item have a parenthesis too many."""
    q = benchmark_boolean_queries(spark, sf_dir)
    q = q.select("query_id", F.when(F.col("query_id") % 7 == 0, F.concat("query", F.lit(" )"))).otherwise(F.col("query")).alias("query"))
    return bl.feedback(q, stored_index(spark, sf_dir).vocab)


# --- bigram model (W4, A12, A13, F8, W8, C8, S11) -------------------------------------

from termite.operators import bigrams as bg  # noqa: E402


def _bigram_arrays(spark, sf_dir):
    return bg.bigram_token_arrays(news(spark, sf_dir), "description")


@register("adjacent_pairs")
def q_adjacent_pairs(spark, sf_dir):
    return bg.adjacent_pairs(_bigram_arrays(spark, sf_dir))


@register("bigram_counts")
def q_bigram_counts(spark, sf_dir):
    return bg.bigram_counts(bg.adjacent_pairs(_bigram_arrays(spark, sf_dir)))


@register("filter_bigrams")
def q_filter_bigrams(spark, sf_dir):
    return bg.filter_bigrams(q_bigram_counts(spark, sf_dir))


@register("sort_bigrams")
def q_sort_bigrams(spark, sf_dir):
    return bg.sort_bigrams(q_bigram_counts(spark, sf_dir))


@register("bigram_model")
def q_bigram_model(spark, sf_dir):
    return bg.bigram_model(news(spark, sf_dir), "description")


@register("bigram_nested")
def q_bigram_nested(spark, sf_dir):
    """The successors of every word, nested in pieces and listed again."""
    counts = bg.filter_bigrams(q_bigram_counts(spark, sf_dir))
    return bg.successors_of(bg.bigram_nested(counts, 8), 8)


# --- thesaurus (A9, J6, W3, W5, F9, J4, C4, C7) ----------------------------------------

from termite.operators import thesaurus as th  # noqa: E402


def corpus_thesaurus(spark, sf_dir, **which) -> DataFrame:
    index = stored_index(spark, sf_dir)
    return th.similar_terms(index.postings, index.vocab, **which)


@register("cooccur_selfjoin")
def q_cooccur_selfjoin(spark, sf_dir):
    """Co-document counts of top-term pairs (term_a < term_b)."""
    t = corpus_thesaurus(spark, sf_dir, once=True)
    return t.select(F.col("term").alias("term_a"), F.col("related").alias("term_b"), "co")


@register("cooccurrence_similarity")
def q_cooccurrence_similarity(spark, sf_dir):
    return corpus_thesaurus(spark, sf_dir)


@register("build_thesaurus")
def q_build_thesaurus(spark, sf_dir):
    return corpus_thesaurus(spark, sf_dir).select("term", "related", "sim")


@register("filter_similarity")
def q_filter_similarity(spark, sf_dir):
    """thesaurus pairs with sim >= 0.75 (pairs that cannot reach it are
    pruned before the shuffle)."""
    thes = corpus_thesaurus(spark, sf_dir, min_sim=K.EXPANSION_MIN_SIM)
    return th.filter_similarity(thes).select("term", "related", "sim")


@register("top_related_terms")
def q_top_related_terms(spark, sf_dir):
    return th.top_related(corpus_thesaurus(spark, sf_dir, best=10), 10)


@register("second_best_term")
def q_second_best_term(spark, sf_dir):
    return th.top_related(corpus_thesaurus(spark, sf_dir, best=1), 1).select("term", "related", "sim")


@register("thesaurus_lookup")
def q_thesaurus_lookup(spark, sf_dir):
    """Only the product of the asked terms with the top terms is computed."""
    qtok = rk.query_tokens(query_table(spark, sf_dir, "benchmark"))
    return th.thesaurus_lookup(qtok, corpus_thesaurus(spark, sf_dir, asked=qtok))


@register("expand_query")
def q_expand_query(spark, sf_dir):
    """C4: benchmark queries with one related term appended per token whose
    best related term has sim >= 0.75; ``(query_id, term, qtf)``."""
    qtok = rk.query_tokens(query_table(spark, sf_dir, "benchmark"))
    # only a best related term with sim >= 0.75 is added: the pruned rows of the
    # asked terms have the same best term whenever that term reaches the threshold
    thes = corpus_thesaurus(spark, sf_dir, min_sim=K.EXPANSION_MIN_SIM, asked=qtok, best=1)
    return rk.query_term_counts(th.expand_query(qtok, thes))


# --- spelling (J5, C3, C5) and the full ranked search (C1) ----------------------------

from termite.operators import spelling as sp  # noqa: E402


def misspelt_benchmark_tokens(spark, sf_dir) -> DataFrame:
    """Benchmark query tokens with their middle character deleted - typing
    errors derived from the data: ``(query_id, pos, term)``."""
    qt = rk.query_tokens(query_table(spark, sf_dir, "benchmark"))
    n = F.length("term")
    half = F.floor(n / 2).cast("int")
    typo = F.concat(F.col("term").substr(F.lit(1), half), F.col("term").substr(half + 2, n))
    return qt.select("query_id", "pos", typo.alias("term"))


@register("nearest_term")
def q_nearest_term(spark, sf_dir):
    """Nearest vocabulary term of every misspelt benchmark token that is
    not itself in the vocabulary."""
    idx = corpus_index(spark, sf_dir)
    toks = misspelt_benchmark_tokens(spark, sf_dir).select("term").distinct()
    unknown = toks.join(idx.vocab.select("term"), "term", "left_anti")
    return sp.nearest_terms(unknown, idx.vocab)


@register("correct_query_terms")
def q_correct_query_terms(spark, sf_dir):
    idx = corpus_index(spark, sf_dir)
    return sp.correct_query_terms(misspelt_benchmark_tokens(spark, sf_dir), idx.vocab)


@register("suggest_query")
def q_suggest_query(spark, sf_dir):
    idx = corpus_index(spark, sf_dir)
    return sp.suggest_query(sp.correct_query_terms(misspelt_benchmark_tokens(spark, sf_dir), idx.vocab))


def vsm_search(spark, sf_dir, queries: DataFrame, k: int = 5, allowed: DataFrame | None = None) -> DataFrame:
    """Normalise -> expand (C4) -> correct unknown terms (J5) -> score
    -> rank (W1) -> top k (W2), of all documents or the ``allowed`` ones.

    Reads the stored index.  Only the thesaurus rows of the queries' terms are
    computed; corrections are computed for the distinct query terms and applied
    to the expanded query (appended terms come from the thesaurus and are
    always in the vocabulary)."""
    index = stored_index(spark, sf_dir)
    qtok = stored(rk.query_tokens(queries), "query-tokens")
    terms = stored(qtok.select("term").distinct(), "query-terms")
    thes = corpus_thesaurus(spark, sf_dir, min_sim=K.EXPANSION_MIN_SIM, asked=terms, best=1)
    expanded = th.expand_query(qtok, thes)
    fixes = sp.correct_query_terms(terms.select(F.lit(0).alias("query_id"), F.lit(0).alias("pos"), "term"), index.vocab)
    corrected = expanded.join(fixes.select("term", "corrected"), "term", "left").select(
        "query_id", F.coalesce("corrected", "term").alias("term"))
    return si.search(index, rk.query_term_counts(corrected), k, allowed)


@register("vsm_search")
def q_vsm_search(spark, sf_dir):
    """C1 over the user turns of ``conversations`` (whole texts)."""
    return vsm_search(spark, sf_dir, query_table(spark, sf_dir, "conversations"))


# --- topics and kNN (A8, J7, W6, A14, J8, C6, F3, F4, F6, A11, B5, C9, C10) ----------

from termite.operators import knn as kn  # noqa: E402
from termite.operators import topics as tp  # noqa: E402
from termite.operators.features import feature_counts  # noqa: E402


def _knn_inputs(spark, sf_dir):
    nw = news(spark, sf_dir)
    train, pred = tp.split_train_predict(nw)
    rows = stored(tp.explode_topics(train), "training-rows")
    return nw, train, pred, rows


@register("split_train_predict")
def q_split_train_predict(spark, sf_dir):
    nw = news(spark, sf_dir)
    return nw.select("doc_id", F.when(F.col("topics").isNotNull(), "train").otherwise("predict")
                     .alias("split"))


@register("explode_topics")
def q_explode_topics(spark, sf_dir):
    return tp.explode_topics(news(spark, sf_dir)).orderBy("doc_id", "topic")


@register("sort_by_doc")
def q_sort_by_doc(spark, sf_dir):
    """The training rows ordered by doc_id (a distributed range sort)."""
    return tp.explode_topics(news(spark, sf_dir)).orderBy("doc_id")


@register("feature_counts")
def q_feature_counts(spark, sf_dir):
    """Counts of the training rows' top terms in every document."""
    nw, train, pred, rows = _knn_inputs(spark, sf_dir)
    tok = ix.token_table(nw, "text")
    top = ix.top_terms(tok.join(rows.select("doc_id"), "doc_id"))
    return feature_counts(tok, top)


def _knn_parts(spark, sf_dir):
    nw, train, pred, rows = _knn_inputs(spark, sf_dir)
    counts = stored(ix.token_table(train, "text").groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("cnt")), "training-counts")
    top = stored(kn.training_top_terms(counts, rows), "training-top-terms")
    tf = stored(counts.join(top, "term").select("doc_id", "term", "cnt"), "training-features")
    pf = stored(feature_counts(ix.token_table(pred, "text"), top), "query-features")
    k = kn.k_for(rows.count())
    return nw, train, pred, rows, tf, pf, k, top


@register("k_nearest")
def q_k_nearest(spark, sf_dir):
    """The k = round(sqrt(n)) nearest training rows of each untopiced document."""
    nw, train, pred, rows, tf, pf, k, top = _knn_parts(spark, sf_dir)
    return kn.nearest_rows(rows, tf, pred, pf, top, k)


@register("knn_join")
def q_knn_join(spark, sf_dir):
    """Squared distances to the candidate training rows (top k kept)."""
    return q_k_nearest(spark, sf_dir).select("doc_id", "train_id", "topic", "dist2")


@register("majority_vote")
def q_majority_vote(spark, sf_dir):
    return kn.majority_vote(q_k_nearest(spark, sf_dir))


@register("knn_topic_classifier")
def q_knn_topic_classifier(spark, sf_dir):
    nw, train, pred, rows = _knn_inputs(spark, sf_dir)
    return kn.knn_topic_classifier(rows, train, pred)


@register("apply_predictions")
def q_apply_predictions(spark, sf_dir):
    nw, train, pred, rows = _knn_inputs(spark, sf_dir)
    p = kn.knn_topic_classifier(rows, train, pred)
    out = kn.apply_predictions(nw, p)
    return out.select("doc_id", F.array_join("topics", " ").alias("topic"))


def _topic_docs(spark, sf_dir, post: DataFrame | None = None):
    nw, train, pred, rows = _knn_inputs(spark, sf_dir)
    return tp.topic_documents(rows, kn.knn_topic_classifier(rows, train, pred, post=post))


@register("topic_documents")
def q_topic_documents(spark, sf_dir):
    return _topic_docs(spark, sf_dir)


@register("union_train_predict")
def q_union_train_predict(spark, sf_dir):
    """Training rows stacked with predicted rows."""
    nw, train, pred, rows = _knn_inputs(spark, sf_dir)
    p = kn.knn_topic_classifier(rows, train, pred)
    return rows.select("doc_id", "topic").unionByName(p.select("doc_id", "topic"))


TOPIC_OF_INTEREST = "en"


@register("topic_restriction")
def q_topic_restriction(spark, sf_dir):
    return tp.topic_restriction(_topic_docs(spark, sf_dir), TOPIC_OF_INTEREST)


@register("build_classification_sets")
def q_build_classification_sets(spark, sf_dir):
    cs = tp.classification_sets(news(spark, sf_dir))
    return cs.select("split", "doc_id", "topic", F.array_join("tokens", " ").alias("tokens"))


@register("topic_restricted_search")
def q_topic_restricted_search(spark, sf_dir):
    """Ranked search restricted to the documents of one topic (train +
    predicted), top 5 per benchmark query."""
    index = stored_index(spark, sf_dir)
    allowed = stored(tp.topic_restriction(_topic_docs(spark, sf_dir, index.postings), TOPIC_OF_INTEREST), "topic-documents")
    post = index.postings.join(allowed, "doc_id", "left_semi")
    return rk.rank_documents(rk.vsm_scores(post, index.vocab, benchmark_terms(spark, sf_dir)))


@register("topic_search")
def q_topic_search(spark, sf_dir):
    """C10 as the whole of C1 (expansion, correction, ranking) among the documents
    of one topic."""
    post = stored_index(spark, sf_dir).postings
    allowed = stored(tp.topic_restriction(_topic_docs(spark, sf_dir, post), TOPIC_OF_INTEREST), "topic-documents")
    return vsm_search(spark, sf_dir, query_table(spark, sf_dir, "benchmark"), allowed=allowed)


# --- sources and sinks (S1-S11, F1, F2, B4) ------------------------------------------

from termite.sources import corpus as cp  # noqa: E402
from termite.sources import sinks as sk  # noqa: E402


def _pages(spark, sf_dir):
    return read_table(spark, sf_dir, "pages", "page_id", "url", "html")


@register("filter_header")
def q_filter_header(spark, sf_dir):
    """catalogue pages whose header marks an English course."""
    return cp.filter_header(cp.catalog_blocks(_pages(spark, sf_dir))).select("page_id", "code", "name")


@register("extract_catalog")
def q_extract_catalog(spark, sf_dir):
    return cp.extract_catalog(_pages(spark, sf_dir))


@register("assign_doc_id")
def q_assign_doc_id(spark, sf_dir):
    """Dense ids in page order over the header-matching blocks."""
    kept = cp.filter_header(cp.catalog_blocks(_pages(spark, sf_dir)))
    return ix.dense_ids(kept.select("page_id"), "page_id", "doc_id")


@register("filter_described")
def q_filter_described(spark, sf_dir):
    return cp.filter_described(news(spark, sf_dir)).select("doc_id")


def _page_files(spark, sf_dir):
    return _pages(spark, sf_dir).select(F.col("page_id").alias("path"), F.col("html").alias("value"))


@register("extract_newswire")
def q_extract_newswire(spark, sf_dir):
    """Tagged records of the page files (record = html, topics = nav links,
    title = title, body = article)."""
    recs = cp.extract_records(_page_files(spark, sf_dir), **cp.PAGE_RECORDS)
    return recs.select(F.col("file").alias("page_id"), "rec_pos",
                       F.array_join("topics", " ").alias("topic"), "name", "description")


@register("extract_positional")
def q_extract_positional(spark, sf_dir):
    """S3: paragraphs zipped with navigation links by position, per page."""
    out = cp.extract_positional(_page_files(spark, sf_dir), body="p", title="a")
    return out.select(F.col("file").alias("page_id"), "pos", "name", "description")


PAGE_END = "</page>\n"


def write_tagged_pages(pages: DataFrame, path: str) -> None:
    """Text files of ``<page id="...">`` records."""
    pages.select(F.concat(F.lit('<page id="'), "page_id", F.lit('">'), "html")).write.option("lineSep", PAGE_END).text(path)


@register("multi_file_scan")
def q_multi_file_scan(spark, sf_dir):
    """The pages written as tagged text files, read back in splits by one path
    glob and the closing tag, and parsed into records."""
    from termite.session import scratch_path

    path = scratch_path(spark, "tagged-pages")
    write_tagged_pages(_pages(spark, sf_dir).select("page_id", "html"), path)
    files = cp.read_tagged_files(spark, f"{path}/part-*.txt", PAGE_END)
    number = F.regexp_extract("value", '^<page id="([0-9]+)">', 1)
    files = files.select(number.cast("long").alias("path"), F.expr("substr(value, instr(value, '>') + 1)").alias("value"))
    recs = cp.extract_records(files, **cp.PAGE_RECORDS)
    return recs.select(F.col("file").alias("page_id"), "rec_pos",
                       F.array_join("topics", " ").alias("topic"), "name", "description")


@register("tagged_record_order")
def q_tagged_record_order(spark, sf_dir):
    """S4 + S5: dense ids of the records of all tagged files, in the order of files
    and of records in a file."""
    from termite.session import scratch_path

    path = scratch_path(spark, "tagged-pages")
    pages = _pages(spark, sf_dir).select("page_id", "html").repartitionByRange("page_id").sortWithinPartitions("page_id")
    write_tagged_pages(pages, path)
    recs = cp.number_records(cp.read_tagged_files(spark, f"{path}/part-*.txt", PAGE_END), "page")
    recs = recs.withColumn("place", F.struct("file", "rec_pos"))
    title = cp.tag_text(cp.element(cp.strip_markup(F.col("rec")), "title"))
    return ix.dense_ids(recs, "place", "doc_id").select("doc_id", title.alias("title"))


# --- fixed value: pages of a host that make one catalogue page at most -----------
CATALOGUE_PAGES = 16


def catalogue_pages(spark, sf_dir) -> DataFrame:
    """Catalogue pages with several course blocks, derived from ``pages``: pages of a
    host with near ids become one, a block each.  A page's subject is its language,
    its number that of its path; every fifth page gives no description."""
    src = _pages(spark, sf_dir)
    clean = cp.strip_markup(F.col("html"))
    number = F.lpad(F.regexp_extract("url", "/(\\d+)(?:[/?#]|$)", 1), 4, "0")
    header = F.concat(F.rpad(F.regexp_extract("html", "<html[^>]*\\blang=\"([^\"]*)\"", 1), 3, "x"), F.lit("&nbsp;"), number,
                      F.lit(" "), cp.element(clean, "title"), F.lit(" (3 units)"))
    text = F.when(F.col("page_id") % 5 != 0, F.concat(
        F.lit('<p class="courseblockdesc noindent">'), cp.element(cp.element(clean, "article"), "p"), F.lit("</p>")))
    block = F.concat(F.lit('<div class="courseblock"><p class="courseblocktitle"><strong>'), header, F.lit("</strong></p>"),
                     F.coalesce(text, F.lit("")), F.lit("</div>"))
    host = F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1)
    blocks = src.groupBy(host.alias("host"), F.floor(F.col("page_id") / CATALOGUE_PAGES).alias("part")).agg(
        F.min("page_id").alias("page_id"), F.array_sort(F.collect_list(F.struct("page_id", block.alias("block")))).alias("blocks"))
    return blocks.select("page_id", F.concat(F.lit("<html><body>"), F.array_join("blocks.block", "\n"), F.lit("</body></html>")).alias("html"))


@register("filter_course_header")
def q_filter_course_header(spark, sf_dir):
    """the course blocks with a header of the pattern."""
    return cp.filter_course_header(cp.course_blocks(catalogue_pages(spark, sf_dir))).select("page_id", "block_pos", "code", "name")


@register("extract_course_blocks")
def q_extract_course_blocks(spark, sf_dir):
    """Every course block of catalogue pages that hold several."""
    return cp.extract_course_blocks(catalogue_pages(spark, sf_dir))


@register("json_sink_source")
def q_json_sink_source(spark, sf_dir):
    return sk.json_round_trip(spark, cp.extract_catalog(_pages(spark, sf_dir)), "courses-json")


@register("csv_sink_source")
def q_csv_sink_source(spark, sf_dir):
    cs = tp.classification_sets(news(spark, sf_dir)).select("split", "doc_id", "topic", "tokens")
    back = sk.csv_round_trip(spark, cs, "classification-csv", ("tokens",))
    return back.select("split", "doc_id", "topic", F.array_join("tokens", " ").alias("tokens"))


@register("parse_list_literal")
def q_parse_list_literal(spark, sf_dir):
    toks = tx.normalise(F.col("text"))
    d = _docs(spark, sf_dir).select("doc_id", cp.list_literal(toks).alias("cell"))
    return d.select("doc_id", "cell", F.array_join(cp.parse_list_literal(F.col("cell")), " ").alias("tokens"))


@register("materialise_corpus")
def q_materialise_corpus(spark, sf_dir):
    return sk.parquet_round_trip(spark, corpus_index(spark, sf_dir).tokens, "tokens")


@register("thesaurus_sink_source")
def q_thesaurus_sink_source(spark, sf_dir):
    return sk.parquet_round_trip(spark, q_build_thesaurus(spark, sf_dir), "thesaurus")


@register("bigram_sink_source")
def q_bigram_sink_source(spark, sf_dir):
    return sk.parquet_round_trip(spark, q_bigram_model(spark, sf_dir), "bigrams")


@register("union_corpora")
def q_union_corpora(spark, sf_dir):
    """Courses (from pages) followed by news (from documents)."""
    return tp.union_corpora(cp.extract_catalog(_pages(spark, sf_dir)), news(spark, sf_dir))


def _corpora(spark, sf_dir) -> DataFrame:
    """Courses and news with the text that is indexed: name and description, and the
    topics of news (P1)."""
    courses = cp.extract_catalog(_pages(spark, sf_dir)).withColumn("topics", F.lit(None).cast("array<string>"))
    both = tp.union_corpora(courses, news(spark, sf_dir), "topics")
    return both.select("corpus", "doc_id", "name", tx.concat_fields("name", "description", F.array_join("topics", " ")).alias("text"))


def _corpora_search(spark, sf_dir, corpus=None) -> DataFrame:
    docs = stored(_corpora(spark, sf_dir), "corpora")
    index = si.write_index(docs, corpus_col="corpus")
    top = si.search(index, benchmark_terms(spark, sf_dir), corpus=corpus)
    return top.join(docs.select("corpus", "doc_id", "name"), ["corpus", "doc_id"]).select(
        "query_id", "rank", "corpus", "doc_id", "name", "score")


@register("corpora_search")
def q_corpora_search(spark, sf_dir):
    """B4 + J3 + J1: one index over courses and news, searched as a whole."""
    return _corpora_search(spark, sf_dir)


@register("corpora_search_courses")
def q_corpora_search_courses(spark, sf_dir):
    """B4 + J3 + J1: the same index, searched in the courses only."""
    return _corpora_search(spark, sf_dir, "course")


# --- lemmas and stems (P10, P11) -------------------------------------------------------

from termite.functions import stemming as stm  # noqa: E402


def corpus_plural_lemmas(vocab_terms: DataFrame) -> DataFrame:
    """A lemma table attested by the corpus itself: ``term`` ending in "s" whose
    form without the "s" is also a corpus term maps to that form."""
    v = vocab_terms.select("term")
    cand = v.where(F.col("term").endswith("s") & (F.length("term") > 2)).select(
        "term", F.expr("substr(term, 1, length(term) - 1)").alias("lemma"))
    return cand.join(v.select(F.col("term").alias("lemma")), "lemma", "left_semi")


@register("lemma_lookup")
def q_lemma_lookup(spark, sf_dir):
    """P10: unstemmed tokens mapped through the lemma table; ``(term, cf)``."""
    idx = corpus_index(spark, sf_dir, stemmer=None)
    lemmas = corpus_plural_lemmas(idx.vocab)
    mapped = stm.apply_term_map(idx.tokens, lemmas, "term", "lemma")
    return ix.term_frequency(mapped)


def corpus_lemmas(spark, sf_dir) -> DataFrame:
    terms = ix.token_table(_docs(spark, sf_dir), "text", None).select("term").distinct()
    return stored(corpus_plural_lemmas(stored(terms, "surface-terms")), "lemmas")


@register("lemmatised_documents")
def q_lemmatised_documents(spark, sf_dir):
    """P13 as the chain lemma -> stop words over the vocabulary (the stem step of
    the same chain has no SQL)."""
    how = cf.Conflation(corpus_lemmas(spark, sf_dir), porter=False)
    t = cf.term_arrays(_docs(spark, sf_dir), "doc_id", "text", how)
    return t.select("doc_id", F.array_join("terms", " ").alias("tokens"), F.size("terms").alias("n_tokens"))


@register("lemma_search")
def q_lemma_search(spark, sf_dir):
    """J3 over an index of lemmas, with queries conflated alike."""
    how = cf.Conflation(corpus_lemmas(spark, sf_dir), porter=False)
    index = si.write_index(_docs(spark, sf_dir), "text", how)
    qtok = rk.query_tokens(query_table(spark, sf_dir, "benchmark"), how)
    return si.search(index, rk.query_term_counts(qtok))


@register("porter_search")
def q_porter_search(spark, sf_dir):
    """J3 over an index of lemmas and Porter stems, as the original conflates."""
    how = cf.Conflation(corpus_lemmas(spark, sf_dir))
    index = si.write_index(_docs(spark, sf_dir), "text", how)
    qtok = rk.query_tokens(query_table(spark, sf_dir, "benchmark"), how)
    return si.search(index, rk.query_term_counts(qtok))


@register("stem_vocabulary")
def q_stem_vocabulary(spark, sf_dir):
    """Porter stems of the distinct unstemmed vocabulary (Arrow UDF)."""
    idx = corpus_index(spark, sf_dir, stemmer=None)
    return stm.porter_stem_terms(idx.vocab)


# --- ranking windows (W1, W2) ----------------------------------------------------------

def _bench_scores(spark, sf_dir):
    index = stored_index(spark, sf_dir)
    return rk.vsm_scores(index.postings, index.vocab, benchmark_terms(spark, sf_dir))


@register("rank_documents")
def q_rank_documents(spark, sf_dir):
    """Every matching document of every benchmark query, ranked."""
    return rk.rank_documents(_bench_scores(spark, sf_dir), None)


@register("top5_results")
def q_top5_results(spark, sf_dir):
    """The first 5 of each ranking."""
    return si.search(stored_index(spark, sf_dir), benchmark_terms(spark, sf_dir), 5)
