"""DuckDB SQL for each registered query (same column names and values)."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from termite.functions import constants as K
from termite.plans import oracle_sql as S

_BUILDERS: dict[str, Callable[[], str]] = {}


def oracle(name: str):
    def deco(fn):
        _BUILDERS[name] = fn
        return fn
    return deco


class _Oracle(Mapping):
    """The SQL texts by query name, each built when it is read."""

    def __getitem__(self, name: str) -> str:
        return _BUILDERS[name]()

    def __iter__(self):
        return iter(_BUILDERS)

    def __len__(self) -> int:
        return len(_BUILDERS)


ORACLE = _Oracle()


def _ranked(scores_cte: str, k: int = K.RESULTS_PER_QUERY) -> str:
    return (
        f"SELECT query_id, rank, doc_id, CAST(score AS DOUBLE) / {K.IDF_UNITS} AS score FROM ("
        f"SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) "
        f"AS INTEGER) AS rank, doc_id, score FROM {scores_cte}) WHERE rank <= {k}"
    )


def _score_ctes(qterms: str = "qterms") -> str:
    return (
        f"w AS (SELECT q.query_id, q.term, q.qtf * v.idf_units AS w FROM {qterms} q "
        f"JOIN vocabu v ON q.term = v.term), "
        "scores AS (SELECT w.query_id, p.doc_id, CAST(sum(p.tf * w.w) AS BIGINT) AS score FROM postings p "
        "JOIN w ON p.term = w.term GROUP BY w.query_id, p.doc_id HAVING sum(p.tf * w.w) > 0)"
    )


@oracle("vsm_score")
def _vsm_score() -> str:
    return (
        f"WITH {S.index_ctes()}, {S.benchmark_queries_cte()}, "
        f"{S.tokens_cte('queries', 'query_id', name='qtok')}, "
        "qterms AS (SELECT doc_id AS query_id, term, count(*) AS qtf FROM qtok GROUP BY 1, 2), "
        f"{_score_ctes()} {_ranked('scores')}"
    )


IDX = S.index_ctes()


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(c for c in ctes if c) + " "


@oracle("explode_tokens")
def _explode_tokens():
    return _with(S.tokens_cte()) + "SELECT doc_id, pos, term FROM tokens"


@oracle("term_frequency")
def _term_frequency():
    return _with(S.tokens_cte()) + "SELECT term, count(*) AS cf FROM tokens GROUP BY term"


@oracle("distinct_terms")
def _distinct_terms():
    return _with(S.tokens_cte()) + (
        "SELECT count(*) AS total_terms, count(DISTINCT term) AS unique_terms FROM tokens")


@oracle("filter_top_terms")
def _filter_top_terms():
    return _with(S.tokens_cte()) + (
        f"SELECT term, count(*) AS cf FROM tokens GROUP BY term HAVING count(*) > {K.TOP_TERM_MIN_CF}")


@oracle("top_terms")
def _top_terms():
    return _filter_top_terms() + " ORDER BY cf DESC, term"


@oracle("most_common")
def _most_common():
    return _with(S.tokens_cte()) + (
        "SELECT term, count(*) AS cf FROM tokens GROUP BY term ORDER BY cf DESC, term LIMIT 20")


@oracle("build_dictionary")
def _build_dictionary():
    return _with(IDX) + "SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id FROM vocab"


@oracle("build_inverted_index")
def _build_inverted_index():
    return _with(IDX) + "SELECT term, doc_id, tf FROM postings"


@oracle("collection_idf")
def _collection_idf():
    return _with(IDX) + "SELECT term, cf, df, round(idf, 6) AS idf FROM vocab"


@oracle("term_weight_matrix")
def _term_weight_matrix():
    return _with(IDX) + (
        "SELECT p.doc_id, p.term, p.tf, CAST(p.tf * v.idf_dec AS DOUBLE) AS tfidf "
        "FROM postings p JOIN vocab v ON p.term = v.term")


@oracle("distinct_terms_per_row")
def _distinct_terms_per_row():
    return _with(IDX) + "SELECT doc_id, count(*) AS n_terms FROM postings GROUP BY doc_id"


QTERMS = (f"{S.benchmark_queries_cte()}, {S.tokens_cte('queries', 'query_id', name='qtok')}, "
          "qterms AS (SELECT doc_id AS query_id, term, count(*) AS qtf FROM qtok GROUP BY 1, 2)")


@oracle("postings_lookup")
def _postings_lookup():
    return _with(IDX, QTERMS) + (
        "SELECT q.query_id, p.term, p.doc_id, p.tf FROM postings p JOIN qterms q ON p.term = q.term")


@oracle("fetch_documents")
def _fetch_documents():
    return (f"WITH top AS ({ORACLE['vsm_score']}), {S.news_ctes()} "
            "SELECT t.query_id, t.rank, t.doc_id, n.name FROM top t JOIN news n ON t.doc_id = n.doc_id")


def _news_map(expr: str) -> str:
    return _with(S.news_ctes()) + f"SELECT doc_id, {expr} AS out FROM news"


P = lambda e: S.strip_punct(e)


@oracle("concat_fields")
def _concat_fields():
    return _news_map("concat_ws(' ', name, description)")


@oracle("strip_punctuation")
def _strip_punctuation():
    return _news_map(P("text"))


@oracle("strip_digits")
def _strip_digits():
    return _news_map("regexp_replace(text, '[0-9]+', '', 'g')")


@oracle("non_alnum_to_space")
def _non_alnum_to_space():
    return _news_map(f"regexp_replace(text, {S.lit(K.NON_ALNUM_PATTERN)}, ' ', 'g')")


@oracle("collapse_whitespace")
def _collapse_whitespace():
    return _news_map(S.collapse_ws("text"))


@oracle("fold_case")
def _fold_case():
    return _news_map("lower(text)")


@oracle("strip_parenthesised")
def _strip_parenthesised():
    return _news_map("regexp_replace(text, '\\([^)]*\\)', '', 'g')")


@oracle("fill_missing")
def _fill_missing():
    return _with(S.news_ctes()) + (
        "SELECT doc_id, coalesce(description, 'NaN') AS description, "
        "coalesce(array_to_string(topics, ' '), 'NaN') AS topic FROM news")


def _tok_out(list_expr: str, src: str = "documents", where: str = "") -> str:
    w = f" WHERE {where}" if where else ""
    return (f"SELECT doc_id, array_to_string(t, ' ') AS tokens, len(t) AS n_tokens FROM "
            f"(SELECT doc_id, {list_expr} AS t FROM {src}{w})")


@oracle("tokenise")
def _tokenise():
    return _tok_out(S.tokenize(P("lower(text)")))


@oracle("remove_stopwords")
def _remove_stopwords():
    return _tok_out(S.normalise("text", None))


@oracle("normalise_documents")
def _normalise_documents():
    return _tok_out(S.normalise("text"))


@oracle("normalise_for_bigrams")
def _normalise_for_bigrams():
    return _with(S.news_ctes()) + _tok_out(S.normalise_for_bigrams("description"), "news",
                                           "description IS NOT NULL")


@oracle("edit_distance")
def _edit_distance():
    return _with(S.tokens_cte(stemmer=None)) + (
        f"SELECT term, stem, levenshtein(term, stem) AS dist FROM (SELECT DISTINCT term, "
        f"{S.s_stem('term')} AS stem FROM tokens)")


def _word_set(e: str) -> str:
    return f"list_distinct(list_filter(regexp_split_to_array({e}, '\\s+'), lambda x: x <> ''))"


@oracle("set_jaccard")
def _set_jaccard():
    a, b = _word_set("prev"), _word_set("text")
    return (
        "SELECT conv_id, turn, CASE WHEN len(list_distinct(list_concat(a, b))) > 0 THEN "
        "len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END AS jaccard FROM ("
        f"SELECT conv_id, turn, {a} AS a, {b} AS b FROM (SELECT conv_id, turn, text, "
        "lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations) "
        "WHERE prev IS NOT NULL)")


@oracle("count_term_in_list")
def _count_term_in_list():
    return _with(S.tokens_cte()) + (
        "SELECT d.doc_id, coalesce(h.cnt, 0) AS cnt FROM documents d LEFT JOIN ("
        "SELECT doc_id, count(*) AS cnt FROM tokens WHERE term = "
        "(SELECT term FROM tokens GROUP BY term ORDER BY count(*) DESC, term LIMIT 1) "
        "GROUP BY doc_id) h ON d.doc_id = h.doc_id")


FEATURES = (
    f"top AS (SELECT term FROM tokens GROUP BY term HAVING count(*) > {K.TOP_TERM_MIN_CF}), "
    "features AS (SELECT t.doc_id, t.term, count(*) AS cnt FROM tokens t "
    "JOIN top USING (term) GROUP BY t.doc_id, t.term)")


@oracle("binarise")
def _binarise():
    return _with(S.tokens_cte(), FEATURES) + (
        "SELECT doc_id, term, CAST(cnt > 0 AS INTEGER) AS present FROM features")


# Sentences of the items, the first term of each without its middle character;
# terms that the corpus lacks are replaced by the nearest corpus term.
_HALF = "CAST(floor(length(x) / 2) AS INTEGER)"
SENT_CLAUSES = (
    "sent AS (SELECT item_id AS query_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS clause_id "
    "FROM (SELECT item_id, regexp_split_to_array(text, '[.!?\\n]+') AS ss FROM benchmark)), "
    "typed AS (SELECT query_id, clause_id, unnest(list_transform(" + S.normalise("s") + ", lambda x, i: "
    f"CASE WHEN i = 1 THEN substr(x, 1, {_HALF}) || substr(x, {_HALF} + 2) ELSE x END)) AS t FROM sent), "
    "bterm AS (SELECT query_id, clause_id, coalesce(" + S.normalise("t") + "[1], lower(t)) AS term FROM typed)")
EVAL = (
    "need AS (SELECT query_id, clause_id, count(*) AS n FROM clauses GROUP BY 1, 2), "
    "hit AS (SELECT c.query_id, c.clause_id, p.doc_id, count(*) AS n FROM postings p "
    "JOIN clauses c ON p.term = c.term GROUP BY 1, 2, 3), "
    "res AS (SELECT DISTINCT h.query_id, h.doc_id FROM hit h JOIN need n "
    "ON h.query_id = n.query_id AND h.clause_id = n.clause_id AND h.n = n.n)")
ITEM_TERMS = "iterms AS (SELECT DISTINCT doc_id AS query_id, term FROM qtok)"


@oracle("boolean_retrieval")
def _boolean_retrieval():
    clauses = ("clauses AS (SELECT DISTINCT b.query_id, b.clause_id, coalesce(f.nearest, b.term) AS term "
               "FROM bterm b LEFT JOIN fix f ON b.term = f.term)")
    return _with(IDX, SENT_CLAUSES, _fixes("bterm"), clauses, EVAL) + "SELECT query_id, doc_id FROM res"


@oracle("bool_and")
def _bool_and():
    return _with(IDX, QTERMS, ITEM_TERMS) + (
        "SELECT p_q.query_id, p_q.doc_id FROM (SELECT i.query_id, p.doc_id, count(*) AS n "
        "FROM postings p JOIN iterms i ON p.term = i.term GROUP BY 1, 2) p_q "
        "JOIN (SELECT query_id, count(*) AS n FROM iterms GROUP BY 1) k "
        "ON p_q.query_id = k.query_id AND p_q.n = k.n")


@oracle("bool_or")
def _bool_or():
    return _with(IDX, QTERMS, ITEM_TERMS) + (
        "SELECT DISTINCT i.query_id, p.doc_id FROM postings p JOIN iterms i ON p.term = i.term")


@oracle("bool_and_not")
def _bool_and_not():
    return (f"SELECT query_id, doc_id FROM ({_boolean_retrieval()}) "
            f"EXCEPT SELECT query_id, doc_id FROM ({_bool_and()})")


@oracle("boolean_search")
def _boolean_search():
    return (f"WITH r AS ({_boolean_retrieval()}), {S.news_ctes()} "
            "SELECT t.query_id, t.rank, t.doc_id, n.name FROM (SELECT query_id, doc_id, "
            "CAST(row_number() OVER (PARTITION BY query_id ORDER BY doc_id) AS INTEGER) AS rank "
            "FROM r) t JOIN news n ON t.doc_id = n.doc_id WHERE t.rank <= 5")


@oracle("boolean_feedback")
def _boolean_feedback():
    words = ("words AS (SELECT b.query_id, b.clause_id, b.pos, coalesce(f.nearest, b.term) AS word, f.nearest IS NOT NULL AS changed "
             "FROM bplace b LEFT JOIN fix f ON b.term = f.term)")
    place = SENT_CLAUSES.replace(
        "typed AS (SELECT query_id, clause_id, unnest(", "typed AS (SELECT query_id, clause_id, generate_subscripts(ts, 1) AS pos, "
        "unnest(ts) AS t FROM (SELECT query_id, clause_id, ").replace(" AS t FROM sent)", " AS ts FROM sent))").replace(
        "bterm AS (SELECT query_id, clause_id,", "bplace AS (SELECT query_id, clause_id, pos,").replace("END)) AS ts", "END) AS ts")
    return _with(IDX, place, "bterm AS (SELECT * FROM bplace)", _fixes("bterm"), words) + (
        "SELECT i.item_id AS query_id, CASE WHEN i.item_id % 7 = 0 THEN 'unbalanced )' ELSE 'ok' END AS status, "
        "CASE WHEN i.item_id % 7 <> 0 AND s.changed THEN s.t END AS suggestion FROM benchmark i LEFT JOIN (SELECT query_id, "
        "string_agg(word, ' ' ORDER BY clause_id, pos) AS t, bool_or(changed) AS changed FROM words GROUP BY 1) s ON s.query_id = i.item_id")


BIGRAM_PAIRS = (
    f"{S.news_ctes()}, bt AS (SELECT doc_id, unnest(t) AS term, generate_subscripts(t, 1) - 1 AS pos "
    f"FROM (SELECT doc_id, {S.normalise_for_bigrams('description')} AS t FROM news "
    "WHERE description IS NOT NULL)), "
    "pairs AS (SELECT doc_id, pos, w1, w2 FROM (SELECT doc_id, pos, term AS w1, "
    "lead(term) OVER (ORDER BY doc_id, pos) AS w2 FROM bt) WHERE w2 IS NOT NULL), "
    "bcounts AS (SELECT w1, w2, count(*) AS cnt FROM pairs GROUP BY w1, w2)")


@oracle("adjacent_pairs")
def _adjacent_pairs():
    return _with(BIGRAM_PAIRS) + "SELECT doc_id, pos, w1, w2 FROM pairs"


@oracle("bigram_counts")
def _bigram_counts():
    return _with(BIGRAM_PAIRS) + "SELECT w1, w2, cnt FROM bcounts"


@oracle("filter_bigrams")
def _filter_bigrams():
    return _with(BIGRAM_PAIRS) + f"SELECT w1, w2, cnt FROM bcounts WHERE cnt >= {K.BIGRAM_MIN_COUNT}"


@oracle("sort_bigrams")
def _sort_bigrams():
    return _with(BIGRAM_PAIRS) + "SELECT w1, w2, cnt FROM bcounts ORDER BY cnt DESC, w1, w2"


@oracle("bigram_model")
def _bigram_model():
    return _filter_bigrams() + " ORDER BY cnt DESC, w1, w2"


@oracle("bigram_nested")
def _bigram_nested():
    return _with(BIGRAM_PAIRS) + (
        "SELECT w1, row_number() OVER (PARTITION BY w1 ORDER BY cnt DESC, w2) AS place, w2, cnt "
        f"FROM bcounts WHERE cnt >= {K.BIGRAM_MIN_COUNT}")


THES_BODY = (
    f"top AS (SELECT term FROM tokens GROUP BY term HAVING count(*) > {K.TOP_TERM_MIN_CF}), "
    "dt AS (SELECT DISTINCT t.doc_id, t.term FROM tokens t JOIN top ON t.term = top.term), "
    "tdf AS (SELECT term, count(*) AS df FROM dt GROUP BY term), "
    "co AS (SELECT a.term AS ta, b.term AS tb, count(*) AS co FROM dt a JOIN dt b "
    "ON a.doc_id = b.doc_id AND a.term < b.term GROUP BY 1, 2), "
    "sym AS (SELECT ta, tb, co, co / greatest(da.df, db.df) AS sim FROM co "
    "JOIN tdf da ON da.term = ta JOIN tdf db ON db.term = tb), "
    "thes AS (SELECT ta AS term, tb AS related, co, sim FROM sym "
    "UNION ALL SELECT tb AS term, ta AS related, co, sim FROM sym), "
    "ranked AS (SELECT term, CAST(row_number() OVER (PARTITION BY term ORDER BY sim DESC, related) "
    "AS INTEGER) AS rank, related, sim FROM thes)")
THES = f"{S.tokens_cte()}, {THES_BODY}"


@oracle("cooccur_selfjoin")
def _cooccur_selfjoin():
    return _with(THES) + "SELECT ta AS term_a, tb AS term_b, co FROM co"


@oracle("cooccurrence_similarity")
def _cooccurrence_similarity():
    return _with(THES) + "SELECT term, related, co, sim FROM thes"


@oracle("build_thesaurus")
def _build_thesaurus():
    return _with(THES) + "SELECT term, related, sim FROM thes"


@oracle("filter_similarity")
def _filter_similarity():
    return _with(THES) + f"SELECT term, related, sim FROM thes WHERE sim >= {K.EXPANSION_MIN_SIM}"


@oracle("top_related_terms")
def _top_related_terms():
    return _with(THES) + f"SELECT term, rank, related, sim FROM ranked WHERE rank <= {K.RELATED_PER_TERM}"


@oracle("second_best_term")
def _second_best_term():
    return _with(THES) + "SELECT term, related, sim FROM ranked WHERE rank = 1"


QTOK = (f"{S.benchmark_queries_cte()}, {S.tokens_cte('queries', 'query_id', name='qtok')}")


@oracle("thesaurus_lookup")
def _thesaurus_lookup():
    return _with(THES, QTOK) + (
        "SELECT q.query_id, q.term, t.related, t.sim FROM (SELECT DISTINCT doc_id AS query_id, term "
        "FROM qtok) q JOIN thes t ON q.term = t.term")


EXPANDED = (
    f"best AS (SELECT term, related AS extra FROM ranked WHERE rank = 1 AND sim >= {K.EXPANSION_MIN_SIM}), "
    "expanded AS (SELECT doc_id AS query_id, term FROM qtok UNION ALL "
    "SELECT q.doc_id AS query_id, b.extra AS term FROM qtok q JOIN best b ON q.term = b.term)")


@oracle("expand_query")
def _expand_query():
    return _with(THES, QTOK, EXPANDED) + (
        "SELECT query_id, term, count(*) AS qtf FROM expanded GROUP BY query_id, term")


MISSPELT = (
    f"{S.benchmark_queries_cte('bq')}, {S.tokens_cte('bq', 'query_id', name='bqtok')}, "
    "mtok AS (SELECT doc_id AS query_id, pos, substr(term, 1, CAST(floor(length(term) / 2) AS INTEGER)) "
    "|| substr(term, CAST(floor(length(term) / 2) AS INTEGER) + 2) AS term FROM bqtok)")


def _fixes(src: str) -> str:
    return (
        f"unk AS (SELECT DISTINCT term FROM {src} WHERE term NOT IN (SELECT term FROM vocab)), "
        f"cand AS (SELECT u.term, v.term AS cand, {S.lev('u.term', 'v.term')} AS dist, "
        "v.first_doc, v.first_pos FROM unk u CROSS JOIN vocab v), "
        "fix AS (SELECT term, cand AS nearest, dist FROM (SELECT *, row_number() OVER "
        "(PARTITION BY term ORDER BY dist, first_doc, first_pos) AS r FROM cand) WHERE r = 1)")


@oracle("nearest_term")
def _nearest_term():
    return _with(IDX, MISSPELT, _fixes("mtok")) + "SELECT term, nearest, dist FROM fix"


CORRECTED = ("corr AS (SELECT m.query_id, m.pos, m.term, coalesce(f.nearest, m.term) AS corrected, "
             "coalesce(f.dist, -1) AS dist FROM mtok m LEFT JOIN fix f ON m.term = f.term)")


@oracle("correct_query_terms")
def _correct_query_terms():
    return _with(IDX, MISSPELT, _fixes("mtok"), CORRECTED) + (
        "SELECT query_id, pos, term, corrected, dist FROM corr")


@oracle("suggest_query")
def _suggest_query():
    return _with(IDX, MISSPELT, _fixes("mtok"), CORRECTED) + (
        "SELECT query_id, string_agg(corrected, ' ' ORDER BY pos) AS suggestion FROM corr "
        "GROUP BY query_id HAVING max(dist) >= 0")


@oracle("vsm_search")
def _vsm_search():
    return _with(
        IDX, THES_BODY, S.conversation_queries_cte(),
        S.tokens_cte("queries", "query_id", name="qtok"), EXPANDED, _fixes("qtok"),
        "qterms AS (SELECT e.query_id, coalesce(f.nearest, e.term) AS term, count(*) AS qtf "
        "FROM expanded e LEFT JOIN fix f ON e.term = f.term GROUP BY 1, 2)",
        _score_ctes()) + _ranked("scores")


KNN = (
    f"{S.news_ctes()}, "
    "tr AS (SELECT doc_id, unnest(topics) AS topic FROM news WHERE topics IS NOT NULL), "
    f"{S.tokens_cte('news', name='tok')}, "
    "ktop AS (SELECT t.term FROM tok t JOIN tr ON t.doc_id = tr.doc_id GROUP BY t.term "
    f"HAVING count(*) > {K.TOP_TERM_MIN_CF}), "
    "feat AS (SELECT t.doc_id, t.term, count(*) AS cnt FROM tok t JOIN ktop ON t.term = ktop.term "
    "GROUP BY 1, 2), "
    "trd AS (SELECT DISTINCT doc_id FROM tr), "
    "prd AS (SELECT doc_id FROM news WHERE topics IS NULL), "
    "tn AS (SELECT d.doc_id, CAST(coalesce(sum(f.cnt * f.cnt), 0) AS BIGINT) AS n2 FROM trd d "
    "LEFT JOIN feat f ON d.doc_id = f.doc_id GROUP BY d.doc_id), "
    "pn AS (SELECT d.doc_id, CAST(coalesce(sum(f.cnt * f.cnt), 0) AS BIGINT) AS n2 FROM prd d "
    "LEFT JOIN feat f ON d.doc_id = f.doc_id GROUP BY d.doc_id), "
    "dots AS (SELECT p.doc_id, t.doc_id AS train_id, CAST(sum(p.cnt * t.cnt) AS BIGINT) AS dot "
    "FROM feat p JOIN feat t ON p.term = t.term "
    "WHERE p.doc_id IN (SELECT doc_id FROM prd) AND t.doc_id IN (SELECT doc_id FROM trd) GROUP BY 1, 2), "
    "dist AS (SELECT p.doc_id, r.doc_id AS train_id, r.topic, "
    "p.n2 + t.n2 - 2 * coalesce(d.dot, 0) AS dist2 FROM pn p CROSS JOIN tr r "
    "JOIN tn t ON t.doc_id = r.doc_id LEFT JOIN dots d ON d.doc_id = p.doc_id AND d.train_id = r.doc_id), "
    "kk AS (SELECT CAST(floor(sqrt(count(*)) + 0.5) AS BIGINT) AS k FROM tr), "
    "nn AS (SELECT doc_id, rank, train_id, topic, dist2 FROM (SELECT doc_id, CAST(row_number() OVER "
    "(PARTITION BY doc_id ORDER BY dist2, train_id, topic) AS INTEGER) AS rank, train_id, topic, dist2 "
    "FROM dist) WHERE rank <= (SELECT k FROM kk)), "
    "votes AS (SELECT doc_id, topic, count(*) AS votes FROM nn GROUP BY 1, 2), "
    "pred AS (SELECT doc_id, topic FROM (SELECT doc_id, topic, row_number() OVER "
    "(PARTITION BY doc_id ORDER BY votes DESC, topic) AS r FROM votes) WHERE r = 1), "
    "tdocs AS (SELECT DISTINCT topic, doc_id FROM (SELECT topic, doc_id FROM tr UNION ALL "
    "SELECT topic, doc_id FROM pred))")


@oracle("split_train_predict")
def _split_train_predict():
    return _with(S.news_ctes()) + (
        "SELECT doc_id, CASE WHEN topics IS NOT NULL THEN 'train' ELSE 'predict' END AS split FROM news")


@oracle("explode_topics")
def _explode_topics():
    return _with(S.news_ctes()) + (
        "SELECT doc_id, unnest(topics) AS topic FROM news WHERE topics IS NOT NULL ORDER BY doc_id, topic")


@oracle("sort_by_doc")
def _sort_by_doc():
    return _explode_topics()


@oracle("feature_counts")
def _feature_counts():
    return _with(KNN) + "SELECT doc_id, term, cnt FROM feat"


@oracle("k_nearest")
def _k_nearest():
    return _with(KNN) + "SELECT doc_id, rank, train_id, topic, CAST(dist2 AS BIGINT) AS dist2 FROM nn"


@oracle("knn_join")
def _knn_join():
    return _with(KNN) + "SELECT doc_id, train_id, topic, CAST(dist2 AS BIGINT) AS dist2 FROM nn"


@oracle("majority_vote")
def _majority_vote():
    return _with(KNN) + "SELECT doc_id, topic FROM pred"


@oracle("knn_topic_classifier")
def _knn_topic_classifier():
    return _majority_vote()


@oracle("apply_predictions")
def _apply_predictions():
    return _with(KNN) + (
        "SELECT n.doc_id, coalesce(array_to_string(n.topics, ' '), p.topic) AS topic FROM news n "
        "LEFT JOIN pred p ON n.doc_id = p.doc_id")


@oracle("topic_documents")
def _topic_documents():
    return _with(KNN) + "SELECT topic, doc_id FROM tdocs"


@oracle("union_train_predict")
def _union_train_predict():
    return _with(KNN) + "SELECT doc_id, topic FROM tr UNION ALL SELECT doc_id, topic FROM pred"


@oracle("topic_restriction")
def _topic_restriction():
    return _with(KNN) + "SELECT doc_id FROM tdocs WHERE topic = 'en'"


@oracle("build_classification_sets")
def _build_classification_sets():
    toks = S.normalise("concat_ws(' ', description, name)")
    return _with(S.news_ctes()) + (
        f"SELECT 'train' AS split, doc_id, unnest(topics) AS topic, array_to_string({toks}, ' ') AS tokens "
        "FROM news WHERE topics IS NOT NULL UNION ALL "
        f"SELECT 'predict' AS split, doc_id, CAST(NULL AS VARCHAR) AS topic, array_to_string({toks}, ' ') "
        "AS tokens FROM news WHERE topics IS NULL")


@oracle("topic_restricted_search")
def _topic_restricted_search():
    return _with(
        KNN, IDX.replace("tokens AS (", "tokens AS (", 1), QTERMS,
        "w AS (SELECT q.query_id, q.term, q.qtf * v.idf_units AS w FROM qterms q JOIN vocabu v ON q.term = v.term)",
        "scores AS (SELECT w.query_id, p.doc_id, CAST(sum(p.tf * w.w) AS BIGINT) AS score FROM postings p "
        "JOIN w ON p.term = w.term WHERE p.doc_id IN (SELECT doc_id FROM tdocs WHERE topic = 'en') "
        "GROUP BY w.query_id, p.doc_id HAVING sum(p.tf * w.w) > 0)") + _ranked("scores")


def _tag_text(e: str) -> str:
    x = f"regexp_replace({e}, '<[^>]*>', ' ', 'g')"
    for a, b in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "),
                 ("&amp;", "&")]:
        x = f"replace({x}, {S.lit(a)}, {S.lit(b)})"
    return S.collapse_ws(x)


def _strip_markup(e: str) -> str:
    x = f"regexp_replace({e}, '(?is)<script\\b.*?</script>', ' ', 'g')"
    x = f"regexp_replace({x}, '(?is)<style\\b.*?</style>', ' ', 'g')"
    return f"regexp_replace({x}, '(?s)<!--.*?-->', ' ', 'g')"


def _elements(e: str, tag: str) -> str:
    """The text after each opening tag, up to a closing tag if one comes first."""
    return (f"list_transform(list_slice(regexp_split_to_array({e}, '(?i)<{tag}\\b[^>]*>'), 2, 1000000), "
            f"lambda y: regexp_replace(y, '(?is)</{tag}\\s*>.*', ''))")


def _element(e: str, tag: str) -> str:
    return f"coalesce({_elements(e, tag)}[1], '')"


BLOCKS = (
    "blocks AS (SELECT page_id, regexp_extract(html, '<html[^>]*\\blang=\"([^\"]*)\"', 1) AS lang, "
    "regexp_extract(url, '/(\\d+)(?:[/?#]|$)', 1) AS code, "
    "trim(" + S.collapse_ws("regexp_replace(lower(" + _tag_text(_element("c", "title")) + "), '\\([^)]*\\)', '', 'g')") + ") AS name, "
    "CASE WHEN length(d) > 0 THEN d END AS description FROM (SELECT page_id, url, html, c, "
    + _tag_text("regexp_extract(" + _element("c", "article") + ", '(?is)</h1>(.*)$', 1)") + " AS d "
    "FROM (SELECT page_id, url, html, " + _strip_markup("html") + " AS c FROM pages))), "
    "hdr AS (SELECT * FROM blocks WHERE lang = 'en' AND length(code) > 0), "
    "courses AS (SELECT doc_id, page_id, code, name, description FROM (SELECT *, "
    "row_number() OVER (ORDER BY page_id) - 1 AS doc_id FROM hdr) WHERE description IS NOT NULL)")


@oracle("filter_header")
def _filter_header():
    return _with(BLOCKS) + "SELECT page_id, code, name FROM hdr"


@oracle("extract_catalog")
def _extract_catalog():
    return _with(BLOCKS) + "SELECT doc_id, page_id, code, name, description FROM courses"


@oracle("json_sink_source")
def _json_sink_source():
    return _extract_catalog()


@oracle("assign_doc_id")
def _assign_doc_id():
    return _with(BLOCKS) + "SELECT page_id, row_number() OVER (ORDER BY page_id) - 1 AS doc_id FROM hdr"


@oracle("filter_described")
def _filter_described():
    return _with(S.news_ctes()) + "SELECT doc_id FROM news WHERE description IS NOT NULL"


def _records(src: str, file_expr: str) -> str:
    rec = "rec"
    items = f"list_transform({_elements(_element(rec, 'nav'), 'a')}, lambda x: lower({_tag_text('x')}))"
    title = (f"lower({S.strip_punct(chr(114) + 'egexp_replace(' + _tag_text(_element(rec, 'title')) + ", '[0-9]+', '', 'g')")})")
    body = ("lower(regexp_replace(" + S.strip_punct(
        f"regexp_replace({_tag_text(_element(rec, 'article'))}, {S.lit(K.NON_ALNUM_PATTERN)}, ' ', 'g')")
        + ", '[0-9]+', '', 'g'))")
    return (
        f"recs AS (SELECT {file_expr} AS file, unnest(rs) AS rec, generate_subscripts(rs, 1) - 1 AS rec_pos "
        f"FROM (SELECT *, {_elements(_strip_markup('html'), 'html')} AS rs FROM {src})), "
        f"recout AS (SELECT file, rec_pos, CASE WHEN len({items}) > 0 THEN array_to_string({items}, ' ') END "
        f"AS topic, CASE WHEN regexp_matches(rec, '(?i)<title\\b[^>]*>') THEN {title} END AS name, "
        f"CASE WHEN regexp_matches(rec, '(?i)<article\\b[^>]*>') THEN {body} END AS description "
        "FROM recs)")


@oracle("extract_newswire")
def _extract_newswire():
    return _with(_records("pages", "page_id")) + (
        "SELECT file AS page_id, rec_pos, topic, name, description FROM recout")


@oracle("multi_file_scan")
def _multi_file_scan():
    return _extract_newswire()


@oracle("tagged_record_order")
def _tagged_record_order():
    return ("SELECT row_number() OVER (ORDER BY page_id) - 1 AS doc_id, "
            f"{_tag_text(_element('c', 'title'))} AS title FROM (SELECT page_id, {_strip_markup('html')} AS c FROM pages)")


COURSES = (
    "src AS (SELECT page_id, url, html, " + _strip_markup("html") + " AS c, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, "
    "page_id // 16 AS part, regexp_extract(url, '/(\\d+)(?:[/?#]|$)', 1) AS num FROM pages), "
    "cblocks AS (SELECT min(page_id) OVER (PARTITION BY host, part) AS page_id, "
    "CAST(row_number() OVER (PARTITION BY host, part ORDER BY page_id) - 1 AS INTEGER) AS block_pos, "
    "rpad(regexp_extract(html, '<html[^>]*\\blang=\"([^\"]*)\"', 1), 3, 'x') AS subject, "
    "CASE WHEN length(num) < 4 THEN lpad(num, 4, '0') ELSE substr(num, 1, 4) END AS num, "
    + S.collapse_ws("regexp_replace(lower(" + _tag_text(_element("c", "title") + " || ' (3 units)'") + "), '\\([^)]*\\)', '', 'g')") + " AS name, "
    "CASE WHEN page_id % 5 <> 0 THEN " + _tag_text(_element(_element("c", "article"), "p")) + " END AS description FROM src), "
    "chdr AS (SELECT page_id, block_pos, lower(subject) || chr(160) || num AS code, name, description FROM cblocks "
    "WHERE regexp_full_match(num, '[0-9][1|2|3|4|9|0][0-9]{2}'))")


@oracle("filter_course_header")
def _filter_course_header():
    return _with(COURSES) + "SELECT page_id, block_pos, code, name FROM chdr"


@oracle("extract_course_blocks")
def _extract_course_blocks():
    return _with(COURSES) + (
        "SELECT doc_id, page_id, block_pos, code, name, description FROM (SELECT *, row_number() OVER "
        "(ORDER BY page_id, block_pos) - 1 AS doc_id FROM chdr) WHERE description IS NOT NULL")


@oracle("extract_positional")
def _extract_positional():
    b = f"list_transform({_elements(_strip_markup('html'), 'p')}, lambda x: {_tag_text('x')})"
    t = f"list_transform({_elements(_strip_markup('html'), 'a')}, lambda x: {_tag_text('x')})"
    return (
        f"WITH z AS (SELECT page_id, {b} AS b, {t} AS t FROM pages), "
        "u AS (SELECT page_id, unnest(range(least(len(b), len(t)))) AS pos, b, t FROM z) "
        "SELECT page_id, pos, CASE WHEN length(t[pos + 1]) > 0 THEN t[pos + 1] ELSE 'NaN' END AS name, "
        "CASE WHEN length(b[pos + 1]) > 0 THEN b[pos + 1] ELSE 'NaN' END AS description FROM u")


@oracle("csv_sink_source")
def _csv_sink_source():
    toks = S.normalise("concat_ws(' ', description, name)")
    return _with(S.news_ctes()) + (
        f"SELECT 'train' AS split, doc_id, unnest(topics) AS topic, "
        f"CASE WHEN len({toks}) > 0 THEN array_to_string({toks}, ' ') END AS tokens "
        "FROM news WHERE topics IS NOT NULL UNION ALL "
        f"SELECT 'predict' AS split, doc_id, CAST(NULL AS VARCHAR) AS topic, "
        f"CASE WHEN len({toks}) > 0 THEN array_to_string({toks}, ' ') END AS tokens "
        "FROM news WHERE topics IS NULL")


@oracle("parse_list_literal")
def _parse_list_literal():
    toks = S.normalise("text")
    return (
        f"SELECT doc_id, cell, CASE WHEN cell <> '-1' THEN array_to_string(string_split("
        f"regexp_replace(cell, '[\\[\\]'' ]', '', 'g'), ','), ' ') END AS tokens FROM ("
        f"SELECT doc_id, CASE WHEN len({toks}) > 0 THEN '[''' || array_to_string({toks}, ''', ''') || ''']' "
        "ELSE '-1' END AS cell FROM documents)")


@oracle("materialise_corpus")
def _materialise_corpus():
    return _explode_tokens()


@oracle("thesaurus_sink_source")
def _thesaurus_sink_source():
    return _build_thesaurus()


@oracle("bigram_sink_source")
def _bigram_sink_source():
    return _bigram_model()


@oracle("union_corpora")
def _union_corpora():
    return _with(BLOCKS, S.news_ctes()) + (
        "SELECT 'course' AS corpus, doc_id, name, description FROM courses UNION ALL "
        "SELECT 'news' AS corpus, doc_id, name, description FROM news")


@oracle("lemma_lookup")
def _lemma_lookup():
    return _with(S.tokens_cte(stemmer=None)) + (
        "SELECT coalesce(l.lemma, t.term) AS term, count(*) AS cf FROM tokens t LEFT JOIN ("
        "SELECT v.term, substr(v.term, 1, length(v.term) - 1) AS lemma FROM (SELECT DISTINCT term FROM tokens) v "
        "WHERE suffix(v.term, 's') AND length(v.term) > 2 AND substr(v.term, 1, length(v.term) - 1) IN "
        "(SELECT DISTINCT term FROM tokens)) l ON t.term = l.term GROUP BY 1")


def _corpora_search(where: str = "") -> str:
    docs = ("corpora AS (SELECT 'course' AS corpus, doc_id, name, concat_ws(' ', name, description) AS text FROM courses UNION ALL "
            "SELECT 'news', doc_id, name, concat_ws(' ', name, description, array_to_string(topics, ' ')) FROM news)")
    rest = IDX[IDX.index("postings AS ("):].replace("min({'doc_id': doc_id,", "min({'doc_id': doc_id.doc_id,")
    return _with(
        BLOCKS, S.news_ctes(), docs, S.tokens_cte("corpora", "{'corpus': corpus, 'doc_id': doc_id}"), rest, QTERMS,
        _score_ctes(), f"inside AS (SELECT * FROM scores {where})", f"best AS ({_ranked('inside')})") + (
        "SELECT query_id, rank, c.corpus, c.doc_id, c.name, score FROM best b JOIN corpora c "
        "ON c.corpus = b.doc_id.corpus AND c.doc_id = b.doc_id.doc_id")


@oracle("corpora_search")
def _corpora_search_all():
    return _corpora_search()


@oracle("corpora_search_courses")
def _corpora_search_courses():
    return _corpora_search("WHERE doc_id.corpus = 'course'")


@oracle("topic_search")
def _topic_search():
    scores = _score_ctes().replace("GROUP BY w.query_id, p.doc_id",
                                   "WHERE p.doc_id IN (SELECT doc_id FROM tdocs WHERE topic = 'en') GROUP BY w.query_id, p.doc_id")
    return _with(
        KNN, IDX, THES_BODY, QTOK, EXPANDED, _fixes("qtok"),
        "qterms AS (SELECT e.query_id, coalesce(f.nearest, e.term) AS term, count(*) AS qtf "
        "FROM expanded e LEFT JOIN fix f ON e.term = f.term GROUP BY 1, 2)", scores) + _ranked("scores")


_RAW_WORDS = S.tokenize(S.strip_punct("lower(text)"))
LEMMAS = (
    S.tokens_cte(stemmer=None, name="plain") + ", surface AS (SELECT DISTINCT term FROM plain), "
    "lemmas AS (SELECT term, substr(term, 1, length(term) - 1) AS lemma FROM surface WHERE suffix(term, 's') AND length(term) > 2 "
    "AND substr(term, 1, length(term) - 1) IN (SELECT term FROM surface))")


def _lemmatised(name: str, source: str, id_expr: str) -> str:
    """``name(doc_id, pos, term)``: tokens after lemma and stop words."""
    return (f"{name} AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1 AS pos, term FROM ("
            f"SELECT w.doc_id, w.place, coalesce(l.lemma, w.word) AS term FROM (SELECT {id_expr} AS doc_id, unnest(ws) AS word, "
            f"generate_subscripts(ws, 1) AS place FROM (SELECT *, {_RAW_WORDS} AS ws FROM {source})) w "
            f"LEFT JOIN lemmas l ON l.term = w.word) WHERE length(term) >= 2 AND NOT list_contains({S.stop_list()}, term))")


@oracle("lemmatised_documents")
def _lemmatised_documents():
    return _with(LEMMAS, _lemmatised("lt", "documents", "doc_id")) + (
        "SELECT d.doc_id, coalesce(tokens, '') AS tokens, CAST(coalesce(n, 0) AS INTEGER) AS n_tokens FROM documents d LEFT JOIN "
        "(SELECT doc_id, string_agg(term, ' ' ORDER BY pos) AS tokens, count(*) AS n FROM lt GROUP BY 1) t ON t.doc_id = d.doc_id")


@oracle("lemma_search")
def _lemma_search():
    rest = IDX[IDX.index("postings AS ("):]
    return _with(LEMMAS, _lemmatised("tokens", "documents", "doc_id"), rest, _lemmatised("qtok", "benchmark", "item_id"),
                 "qterms AS (SELECT doc_id AS query_id, term, count(*) AS qtf FROM qtok GROUP BY 1, 2)",
                 _score_ctes()) + _ranked("scores")


@oracle("rank_documents")
def _rank_documents():
    return (f"WITH {S.index_ctes()}, {QTERMS}, {_score_ctes()} "
            "SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) "
            f"AS INTEGER) AS rank, doc_id, CAST(score AS DOUBLE) / {K.IDF_UNITS} AS score FROM scores")


@oracle("top5_results")
def _top5_results():
    return ORACLE["vsm_score"]
