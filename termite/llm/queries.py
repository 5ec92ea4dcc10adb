"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termite.session import ship_package, table_path

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        REGISTRY[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name)).select(*cols)


# Words of the contract in SQL: runs of characters other than ASCII white space.
SQL_WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"


@register("op6_substring_dedup", rf"""
WITH w AS (SELECT doc_id, {SQL_WORDS.format(text='text')} AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS i FROM w WHERE len(ws) >= 35),
wins AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 34), ' ') AS win FROM starts),
again AS (SELECT doc_id, i FROM wins WHERE win IN (SELECT win FROM wins GROUP BY win HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM again, (SELECT unnest(range(35)) AS k)),
word AS (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS i FROM w),
kept AS (SELECT word.doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n
         FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id""")
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words inside any 35-word window that occurs more than once, removed."""
    from termite.llm.substring_dedup import remove_repeats

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return remove_repeats(docs, with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


@register("op5_ngram_jaccard_join", rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_transform({SQL_WORDS.format(text='text')},
                     lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(list_transform(generate_series(1, greatest(1, len(ws) - 4)),
       lambda i: array_to_string(list_slice(ws, i, i + 4), ' '))) AS s FROM w WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 75 * (x.n + y.n - o)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id, doc_id AS c FROM w UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON r.c = e.a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.c) AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id JOIN reach r ON r.doc_id = w.doc_id GROUP BY ALL""")
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets reach a Jaccard of 0.75."""
    from termite.llm.ngram_join import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "n_shingles", "component_id")


@register("op9_quality_rules", rf"""
WITH w AS (SELECT doc_id, text, {SQL_WORDS.format(text='text')} AS ws FROM documents),
wins AS (SELECT doc_id, k, i, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS win FROM
         (SELECT doc_id, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i
          FROM w, (SELECT unnest([5, 8, 101]) AS k) WHERE len(ws) >= k)),
again AS (SELECT doc_id, k, i FROM wins QUALIFY count(*) OVER (PARTITION BY doc_id, k, win) > 1),
hit AS (SELECT doc_id, k, count(DISTINCT i + j) AS n FROM again, (SELECT unnest(range(101)) AS j) WHERE j < k GROUP BY 1, 2),
counts AS (SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
  length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
  coalesce(h8.n, 0) AS n_repeat_words, coalesce(h5.n, 0) AS n_covered_words, h101.n IS NOT NULL AS long_repeat
  FROM w LEFT JOIN hit h8 ON h8.doc_id = w.doc_id AND h8.k = 8 LEFT JOIN hit h5 ON h5.doc_id = w.doc_id AND h5.k = 5
  LEFT JOIN hit h101 ON h101.doc_id = w.doc_id AND h101.k = 101)
SELECT doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_repeat_words,
  n_covered_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * n_covered_words <= 40 * n_words AND NOT long_repeat AS kept
FROM counts""")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of each document; repeats from its suffix array."""
    from termite.llm.quality import quality

    return quality(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words",
        "base_failed", "kept")


SQL_LOWER = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL_BENCH_WORDS = (r"regexp_extract_all(" + SQL_LOWER.format(x="coalesce(text, '')")
                   + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


@register("op2_benchmark_decontamination", rf"""
WITH b AS (SELECT item_id, {SQL_BENCH_WORDS} AS ws FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(10, len(ws)) AS k, array_to_string(list_slice(ws, i, i + 9), ' ') AS win
       FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 9))) AS i FROM b WHERE len(ws) > 0)),
d AS (SELECT doc_id, {SQL_BENCH_WORDS} AS ws FROM documents),
dw AS (SELECT doc_id, k, i, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS win FROM
       (SELECT doc_id, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i
        FROM d, (SELECT DISTINCT k FROM iw) WHERE len(ws) >= k)),
hit AS (SELECT doc_id, dw.k, i, item_id FROM dw JOIN iw ON dw.win = iw.win),
n AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hit, (SELECT unnest(range(10)) AS j) WHERE j < k GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id""")
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document words inside any occurrence of a benchmark item's word window."""
    from termite.llm.decontaminate import report

    return report(table(spark, sf_dir, "documents", "doc_id", "text"),
                  table(spark, sf_dir, "benchmark", "item_id", "text"))


@register("op4_source_mixing", rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(len({SQL_WORDS.format(text='text')}) AS BIGINT) AS size,
           md5(CAST(doc_id AS VARCHAR)) AS o FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r
      FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][r % 3 + 1] AS weight, [0.5, 0.0, -0.5][r % 3 + 1]::DOUBLE AS slope FROM s),
level(l, was) AS (
  SELECT CAST((SELECT sum(source_size) FROM w) AS DOUBLE) / (SELECT sum(weight) FROM w), -1::DOUBLE
  UNION ALL
  SELECT CAST((SELECT sum(source_size) FROM w) - (SELECT coalesce(sum(3 * source_size), 0) FROM w WHERE 3 * source_size <= l * weight) AS DOUBLE)
         / (SELECT sum(weight) FROM w WHERE 3 * source_size > l * weight), l FROM level WHERE l <> was),
t AS (SELECT source, source_size, slope, least(CAST(3 * source_size AS DOUBLE), (SELECT max(l) FROM level) * weight) AS target FROM w),
p AS (SELECT d.*, t.source_size, t.target, t.slope, CAST(floor(t.target + 0.5) AS BIGINT) AS words,
        CAST(sum(size) OVER (PARTITION BY d.source ORDER BY o, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
m AS (SELECT *, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS times FROM p),
k AS (SELECT *, times * size + greatest(0, least(size, words - times * source_size - start)) AS taken,
        least(1.0::DOUBLE, CAST(start AS DOUBLE) / target) AS q FROM m)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
  CASE WHEN taken > 0 THEN 2 * q / ((1 + slope) + sqrt(greatest(0.0::DOUBLE, (1 + slope) * (1 + slope) - 4 * slope * q))) END AS position
FROM k""")
def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document, in order of training position."""
    from termite.llm.curriculum import mix

    return mix(table(spark, sf_dir, "documents", "doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken", "position").orderBy("position", "doc_id")


@register("op10_url_filters")
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path and verdict of each page's URL: a rule's, else the trees'."""
    from termite.llm.url_filter import judge

    return judge(table(spark, sf_dir, "pages", "page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict", "score")


@register("op1_lattice_likelihood")
def op1_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of each text over all its subword segmentations."""
    from termite.llm.lattice_lm import score

    return score(table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op3_page_differencing")
def op3_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page: what it does not share with its nearest neighbour."""
    from termite.llm.page_diff import extract

    return extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


@register("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each text by a network learned from the other documents."""
    from termite.llm.language_id import identify

    return identify(table(spark, sf_dir, "documents", "doc_id", "text", "lang")).select(
        "doc_id", "held_out", "lang_pred", "score")


# Base32 of a hex digest: eight groups of ten hex digits, five bits a character.
SQL_BASE32 = ("array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((("
              "CAST('0x' || substr({hex}, CAST(10 * (i // 8) + 1 AS BIGINT), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS BIGINT))"
              " & 31) + 1 AS BIGINT), 1)), '')")


@register("op8_arc_to_warc", f"""
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS h, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
m AS (SELECT h, max(page_id) AS original FROM p GROUP BY h)
SELECT page_id, payload_bytes, {SQL_BASE32.format(hex='p.h')} AS payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = original THEN NULL ELSE original END AS refers_to
FROM p JOIN m ON p.h = m.h""")
def op8_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the WARC archives made from the pages' ARC archives."""
    from termite.llm.archives import archive_pages

    return archive_pages(table(spark, sf_dir, "pages", "page_id", "url", "html")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# CRC-32 of a decimal number's digits, bit by bit (reflected polynomial 0xEDB88320).
SQL_CRC32 = ("xor(list_reduce(list_transform(string_split(CAST({x} AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT)), lambda s, b:"
             " list_reduce(range(8), lambda t, k: xor(t >> 1, 3988292384 * (t & 1)), xor(s, b)), CAST(4294967295 AS BIGINT)), 4294967295)")


@register("op13_periodic_runs", rf"""
WITH d AS (SELECT doc_id, {SQL_WORDS.format(text='text')} AS ws, {SQL_CRC32.format(x='doc_id')} AS h FROM documents),
s AS (SELECT doc_id, ws, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS planted, (h // 10) % greatest(1, len(ws)) AS a, 3 + (h // 10) % 8 AS m FROM d),
t AS (SELECT *, 1 + (n - a) // m AS p FROM s),
w AS (SELECT doc_id, n, CASE WHEN planted THEN list_transform(range(n), lambda i: ws[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1])
      ELSE ws END AS ws FROM t),
word AS (SELECT doc_id, n, unnest(ws) AS word, unnest(range(n)) AS i FROM w),
same AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM word x JOIN word y
         ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretch AS (SELECT doc_id, q, min(i) AS start, max(i) + q + 1 - min(i) AS length FROM
            (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM same) GROUP BY doc_id, q, g),
run AS (SELECT doc_id, start, length, min(q) AS period FROM stretch WHERE length >= greatest(6, 4 * q) GROUP BY ALL),
best AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1),
total AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS r
          FROM run GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i GROUP BY 1)
SELECT w.doc_id, coalesce(n_runs, 0) AS n_runs, best.start, best.length, best.period,
       1000 * best.length // best.period AS exponent_milli,
       sha256(coalesce(r, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM w LEFT JOIN best ON best.doc_id = w.doc_id LEFT JOIN total ON total.doc_id = w.doc_id LEFT JOIN kept ON kept.doc_id = w.doc_id""")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated word sequences; in a tenth of the documents, whose ids'
    checksums say so, the words from one place on are made periodic first."""
    from termite.llm.periodic_runs import periodic_runs

    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("h", F.crc32(F.col("doc_id").cast("string")))
    docs = docs.withColumn("ws", F.when(F.expr("h % 10 = 0"), F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))))
    docs = docs.withColumn("n", F.size("ws")).withColumn("a", F.expr("cast(h div 10 % n as int)"))
    docs = docs.withColumn("p", F.expr("cast(1 + (n - a) div (3 + h div 10 % 8) as int)"))
    made = F.expr("concat(slice(ws, 1, a), slice(flatten(array_repeat(slice(ws, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a))")
    docs = docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))
    found = periodic_runs(docs)
    r = F.col("runs")
    more = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    best = F.when(F.size(r) > 0, F.reduce(r, F.element_at(r, 1), lambda x, y: F.when(more(y, x), y).otherwise(x)))
    lines = F.transform(r, lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size(r).cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


@register("op12_phrase_collocations", rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array({SQL_LOWER.format(x="coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM p),
total AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY 1),
f AS (SELECT lang, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS g, count(*) AS f FROM
      (SELECT lang, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k)
      GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT *, string_split(g, ' ') AS ws FROM f WHERE k >= 2),
cut AS (SELECT c.lang, c.g, c.f AS a, c.k, j, x.f AS l, y.f AS r, x.g AS start, y.g AS rest
        FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM c) c
        JOIN f x ON x.lang = c.lang AND x.g = array_to_string(list_slice(c.ws, 1, j), ' ')
        JOIN f y ON y.lang = c.lang AND y.g = array_to_string(list_slice(c.ws, j + 1, c.k), ' ')),
inside AS (SELECT lang, start AS g FROM cut WHERE j = k - 1 AND l = a UNION SELECT lang, rest FROM cut WHERE j = 1 AND r = a),
scored AS (SELECT cut.*, n, (1000 * CAST(a AS HUGEINT) * n) // (CAST(l AS HUGEINT) * r) AS score FROM cut JOIN total ON total.lang = cut.lang),
best AS (SELECT s.* FROM scored s ANTI JOIN inside ON inside.lang = s.lang AND inside.g = s.g
         QUALIFY row_number() OVER (PARTITION BY s.lang, s.g ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM best)
SELECT lang, rank, g AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000""")
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 phrases of each language whose words occur together most."""
    from termite.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents", "text", "lang"))


@register("op11_super_minhash", rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_transform({SQL_WORDS.format(text='text')},
                     lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(list_transform(generate_series(1, greatest(1, len(ws) - 3)),
       lambda i: array_to_string(list_slice(ws, i, i + 3), ' '))) AS s FROM w WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id, doc_id AS c FROM w UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON r.c = e.a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.c) AS component_id, w.doc_id = min(r.c) AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id JOIN reach r ON r.doc_id = w.doc_id GROUP BY w.doc_id, n.n""")
def op11_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets reach a Jaccard of 0.8."""
    from termite.llm.super_minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
