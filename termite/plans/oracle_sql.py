"""SQL building blocks for the DuckDB oracle.

The oracle is the correctness reference for the Spark jobs: each registered
query has an equivalent ANSI/DuckDB SQL text written from the same fixed values
(`termite.functions.constants`), over the pre-registered driver views.
"""

from __future__ import annotations

from termite.functions import constants as K


def lit(value: str) -> str:
    return K.sql_quote(value)


def stop_list() -> str:
    return "[" + ", ".join(lit(w) for w in K.stop_words()) + "]"


def s_stem(x: str = "x") -> str:
    return (
        f"CASE WHEN suffix({x}, 'ies') AND NOT suffix({x}, 'eies') AND NOT suffix({x}, 'aies') "
        f"THEN substr({x}, 1, length({x}) - 3) || 'y' "
        f"WHEN suffix({x}, 'es') AND NOT suffix({x}, 'aes') AND NOT suffix({x}, 'ees') "
        f"AND NOT suffix({x}, 'oes') THEN substr({x}, 1, length({x}) - 1) "
        f"WHEN suffix({x}, 's') AND NOT suffix({x}, 'us') AND NOT suffix({x}, 'ss') "
        f"THEN substr({x}, 1, length({x}) - 1) ELSE {x} END"
    )


def strip_punct(expr: str) -> str:
    return f"translate({expr}, {lit(K.PUNCTUATION)}, '')"


def tokenize(expr: str) -> str:
    return f"regexp_extract_all({expr}, {lit(K.TOKEN_PATTERN)})"


def normalise(expr: str, stemmer: str | None = "s") -> str:
    """P13 as a DuckDB list expression."""
    toks = tokenize(strip_punct(f"lower({expr})"))
    if stemmer == "s":
        toks = f"list_transform({toks}, lambda x: {s_stem('x')})"
    return f"list_filter({toks}, lambda x: length(x) >= 2 AND NOT list_contains({stop_list()}, x))"


def collapse_ws(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '[\\s\\x{{00a0}}]+', ' ', 'g'))"


def normalise_for_bigrams(expr: str, stemmer: str | None = "s") -> str:
    t = f"regexp_replace({strip_punct(collapse_ws(expr))}, '[0-9]+', '', 'g')"
    return normalise(t, stemmer)


def tokens_cte(source: str = "documents", id_expr: str = "doc_id", text_expr: str = "text",
               stemmer: str | None = "s", name: str = "tokens", where: str = "") -> str:
    """``name(doc_id, pos, term)`` over a table."""
    w = f" WHERE {where}" if where else ""
    return (
        f"{name} AS (SELECT doc_id, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos "
        f"FROM (SELECT {id_expr} AS doc_id, {normalise(text_expr, stemmer)} AS toks FROM {source}{w}) "
        f"WHERE len(toks) > 0)"
    )


def index_ctes(stemmer: str | None = "s") -> str:
    """tokens, postings, vocab (with idf, idf_dec) over ``documents``."""
    return ", ".join([
        tokens_cte(stemmer=stemmer),
        "postings AS (SELECT term, doc_id, count(*) AS tf, min(pos) AS first_pos "
        "FROM tokens GROUP BY term, doc_id)",
        "vocab0 AS (SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df, "
        "min({'doc_id': doc_id, 'first_pos': first_pos}) AS f FROM postings GROUP BY term)",
        "vocab AS (SELECT term, cf, df, f.doc_id AS first_doc, f.first_pos AS first_pos, "
        "ln((1 + (SELECT sum(cf) FROM vocab0)) / (1 + cf)) + 1 AS idf, "
        f"CAST(round(ln((1 + (SELECT sum(cf) FROM vocab0)) / (1 + cf)) + 1, {K.IDF_SCALE}) "
        f"AS {K.SCORE_DECIMAL}) AS idf_dec FROM vocab0), "
        f"vocabu AS (SELECT *, CAST(idf_dec * {K.IDF_UNITS} AS BIGINT) AS idf_units FROM vocab)",
    ])


def news_ctes() -> str:
    """``news(doc_id, name, description, topics, text)`` as in
    `termite.sources.tables.news_documents`."""
    return (
        "news AS (SELECT d.doc_id, split_part(d.text, chr(10), 1) AS name, "
        "CASE WHEN strpos(d.text, chr(10)) > 0 "
        "AND length(substr(d.text, strpos(d.text, chr(10)) + 1)) > 0 "
        "THEN substr(d.text, strpos(d.text, chr(10)) + 1) END AS description, "
        "CASE WHEN l.doc_id IS NOT NULL THEN [d.lang, d.source] END AS topics, d.text "
        "FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id)"
    )


def benchmark_queries_cte(name: str = "queries") -> str:
    return f"{name} AS (SELECT item_id AS query_id, text FROM benchmark)"


def conversation_queries_cte(name: str = "queries") -> str:
    return (f"{name} AS (SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS query_id, text FROM conversations "
            f"WHERE role = 'user')")


def codepoint_safe(expr: str) -> str:
    """Map each letter of U+00DF..U+00FF to one single-byte placeholder (a
    control character or punctuation, which never occurs in a term), so that
    DuckDB's byte-wise ``levenshtein`` counts code points on these terms."""
    src = "".join(chr(c) for c in range(0xDF, 0x100))
    dst = " || ".join([f"chr({i})" for i in range(1, 32)] + ["'!'", "'\"'"])
    return f"translate({expr}, {lit(src)}, {dst})"


def lev(a: str, b: str) -> str:
    return f"levenshtein({codepoint_safe(a)}, {codepoint_safe(b)})"
