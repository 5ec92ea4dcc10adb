"""Corpus extraction from raw markup.

Markup is handled with built-in regular-expression column functions; no
per-row parser runs.  ``strip_markup`` drops scripts, styles and comments
(a script may hold ``</p>``), ``tag_text`` removes tags, decodes the basic
entities and collapses whitespace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termite.functions import text as tx
from termite.operators.index import dense_ids, ordinal_within

# --- fixed values: the entities decoded in page text, '&amp;' last -----------
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "),
            ("&amp;", "&")]
# A catalogue page is kept when its language is this one (the original kept
# English courses only).
CATALOG_LANG = "en"


def strip_markup(col: Column) -> Column:
    c = F.regexp_replace(col, "(?is)<script\\b.*?</script>", " ")
    c = F.regexp_replace(c, "(?is)<style\\b.*?</style>", " ")
    return F.regexp_replace(c, "(?s)<!--.*?-->", " ")


def decode_entities(col: Column) -> Column:
    for src, dst in ENTITIES:
        col = F.replace(col, F.lit(src), F.lit(dst))
    return col


def tag_text(col: Column) -> Column:
    return tx.collapse_whitespace(decode_entities(F.regexp_replace(col, "<[^>]*>", " ")))


def elements(col: Column, tag: str) -> Column:
    """Inner markup of every ``<tag>`` element, in document order.  An element
    ends at its closing tag, at the next opening tag or at the end of the text,
    so one that is never closed is neither lost nor merged with the next."""
    parts = F.split(col, f"(?i)<{tag}\\b[^>]*>")
    return F.transform(F.slice(parts, 2, F.size(parts)),
                       lambda x: F.regexp_replace(x, f"(?is)</{tag}\\s*>.*", ""))


def element(col: Column, tag: str) -> Column:
    """Inner markup of the first ``<tag>`` element ('' when absent)."""
    return F.coalesce(F.try_element_at(elements(col, tag), F.lit(1)), F.lit(""))


def has_element(col: Column, tag: str) -> Column:
    return col.rlike(f"(?i)<{tag}\\b[^>]*>")


def _nullify(col: Column) -> Column:
    return F.when(F.length(col) > 0, col)


# --- S1 + F1 + S5 + F2: course catalogue ---------------------------------------

def catalog_blocks(pages: DataFrame) -> DataFrame:
    """S1 before filtering: ``(page_id, lang, code, name, description)``.

    name = page title, lower-cased, parenthesised parts removed; description =
    the article text after its heading (NULL when empty); code = the numeric
    path segment of the URL."""
    clean = strip_markup(F.col("html"))
    name = F.trim(tx.collapse_whitespace(tx.strip_parenthesised(F.lower(tag_text(element(clean, "title"))))))
    desc = tag_text(F.regexp_extract(element(clean, "article"), "(?is)</h1>(.*)$", 1))
    return pages.select(
        "page_id",
        F.regexp_extract("html", "<html[^>]*\\blang=\"([^\"]*)\"", 1).alias("lang"),
        F.regexp_extract("url", "/(\\d+)(?:[/?#]|$)", 1).alias("code"),
        name.alias("name"),
        _nullify(desc).alias("description"),
    )


def filter_header(blocks: DataFrame, lang: str = CATALOG_LANG) -> DataFrame:
    """blocks whose header identifies a course of the wanted language."""
    return blocks.where((F.col("lang") == lang) & (F.length("code") > 0))


def filter_described(docs: DataFrame) -> DataFrame:
    """documents with a description."""
    return docs.where(F.col("description").isNotNull())


def extract_catalog(pages: DataFrame, lang: str = CATALOG_LANG) -> DataFrame:
    """``(doc_id, page_id, code, name, description)``.  Ids are dense in
    page order over every header-matching block, so a block dropped for lack
    of a description still consumes its id (as in the original)."""
    kept = filter_header(catalog_blocks(pages), lang)
    with_ids = dense_ids(kept, "page_id", "doc_id")
    return filter_described(with_ids).select("doc_id", "page_id", "code", "name", "description")


# --- fixed values: the header of a course block (subject, NBSP, number) ---------
# The second digit tells the language of a course; "|" is a member of its class.
COURSE_HEADER = "^([\\p{L}\\p{N}_]{3}\u00a0[0-9][1|2|3|4|9|0][0-9]{2})[\\s\u00a0](.*)"
COURSE_BLOCK = "(?i)<div\\b[^>]*\\bclass=\"(?:[^\"]*\\s)?courseblock(?:\\s[^\"]*)?\"[^>]*>"
COURSE_DESCRIPTION = "(?i)<p\\b[^>]*\\bclass=\"courseblockdesc noindent\"[^>]*>"


def course_blocks(pages: DataFrame) -> DataFrame:
    """S1 for pages that hold any number of course blocks: ``(page_id, block_pos,
    code, name, description)``, one row a block, before filtering.

    A block reaches from its opening tag to the next block's.  Its header is the
    first ``<strong>``, lower-cased: code (NULL where it does not fit
    ``COURSE_HEADER``) and name, without parenthesised parts.  Its description is
    the paragraph marked as such; NULL when absent."""
    src = strip_markup(F.col("html"))
    parts = F.split(src, COURSE_BLOCK)
    blocks = pages.select("page_id", F.posexplode(F.slice(parts, 2, F.size(parts))).alias("block_pos", "block"))
    nbsp = F.regexp_replace(element(F.col("block"), "strong"), "(?i)&nbsp;|&#160;|&#xa0;", "\u00a0")
    header = F.lower(decode_entities(F.regexp_replace(nbsp, "<[^>]*>", "")))
    header = F.regexp_replace(header, "^[ \\t\\r\\n]+", "")
    text = F.split("block", COURSE_DESCRIPTION, 2)
    code = _nullify(F.regexp_extract(header, COURSE_HEADER, 1))
    return blocks.select(
        "page_id", "block_pos", code.alias("code"),
        tx.collapse_whitespace(tx.strip_parenthesised(F.regexp_extract(header, COURSE_HEADER, 2))).alias("name"),
        F.when(F.size(text) > 1, tag_text(F.regexp_replace(text[1], "(?is)</p\\s*>.*", ""))).alias("description"))


def filter_course_header(blocks: DataFrame) -> DataFrame:
    """blocks whose header fits the pattern."""
    return blocks.where(F.col("code").isNotNull())


def extract_course_blocks(pages: DataFrame) -> DataFrame:
    """S1 + F1 + S5 + F2: ``(doc_id, page_id, block_pos, code, name, description)``.
    Ids are dense in page and block order over the blocks with a fitting header; one
    without a description is dropped, but its id is used up."""
    kept = filter_course_header(course_blocks(pages)).withColumn("place", F.struct("page_id", "block_pos"))
    with_ids = dense_ids(kept, "place", "doc_id")
    return filter_described(with_ids).select("doc_id", "page_id", "block_pos", "code", "name", "description")


# --- S2 / S4: tagged records ----------------------------------------------------

def extract_records(files: DataFrame, record: str = "reuters", topics: str = "topics",
                    topic_item: str = "d", title: str = "title", body: str = "body",
                    file_col: str = "path", text_col: str = "value") -> DataFrame:
    """One row per ``<record>`` element of every file:
    ``(file, rec_pos, topics ARRAY, name, description)``.

    topics = lower-cased texts of the ``topic_item`` children of ``topics``
    (NULL when there are none); name = title without digits and punctuation,
    lower-cased; description = body with non-alphanumeric runs as one space,
    without punctuation and digits, lower-cased; NULL when the element is
    absent."""
    src = strip_markup(F.col(text_col))
    recs = files.select(F.col(file_col).alias("file"),
                        F.posexplode(elements(src, record)).alias("rec_pos", "rec"))
    rec = F.col("rec")
    items = F.transform(elements(element(rec, topics), topic_item), lambda x: F.lower(tag_text(x)))
    title_txt = F.lower(tx.strip_punctuation(tx.strip_digits(tag_text(element(rec, title)))))
    body_txt = F.lower(tx.strip_digits(tx.strip_punctuation(tx.non_alnum_to_space(tag_text(element(rec, body))))))
    return recs.select(
        "file", "rec_pos",
        F.when(F.size(items) > 0, items).alias("topics"),
        F.when(has_element(rec, title), title_txt).alias("name"),
        F.when(has_element(rec, body), body_txt).alias("description"),
    )


PAGE_RECORDS = dict(record="html", topics="nav", topic_item="a", title="title", body="article")


def read_text_files(spark: SparkSession, glob: str) -> DataFrame:
    """Every file matching ``glob`` as one row ``(path, value)``."""
    return spark.read.text(glob, wholetext=True).select(
        F.input_file_name().alias("path"), "value")


def read_tagged_files(spark: SparkSession, glob: str, end: str) -> DataFrame:
    """S4 + S2: the pieces of all files matching ``glob`` that the delimiter ``end``
    (a closing tag) separates: ``(file, split_start, row, value)``.

    The delimiter is the text source's line separator, so a large file is read by
    many tasks and no file is held whole.  ``(file, split_start, row)`` orders the
    pieces as they stand.  Bytes that are no UTF-8 are skipped, a replacement
    character that stands in the text too."""
    value = F.replace(F.make_valid_utf8("value"), F.lit("\ufffd"), F.lit(""))
    return spark.read.option("lineSep", end).text(glob).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("row"), value.alias("value"))


def number_records(pieces: DataFrame, record: str) -> DataFrame:
    """``(file, rec_pos, rec)``: the ``<record>`` elements of the pieces of
    :func:`read_tagged_files`, numbered within their file."""
    recs = pieces.select("file", "split_start", "row", F.posexplode(elements(F.col("value"), record)).alias("at", "rec"))
    placed = ordinal_within(recs, "file", [F.col("split_start"), F.col("row"), F.col("at")], "rec_pos")
    return placed.select("file", (F.col("rec_pos") - 1).alias("rec_pos"), "rec")


# --- S3: positional zip -----------------------------------------------------------

def extract_positional(files: DataFrame, body: str = "body", title: str = "title",
                       file_col: str = "path", text_col: str = "value") -> DataFrame:
    """S3: all bodies and all titles of a file, zipped by position (cut to the
    shorter list); empty texts become "NaN".  ``(file, pos, name, description)``."""
    src = strip_markup(F.col(text_col))
    b = F.transform(elements(src, body), lambda x: tag_text(x))
    t = F.transform(elements(src, title), lambda x: tag_text(x))
    n = F.least(F.size(b), F.size(t))
    z = F.arrays_zip(F.slice(b, 1, n).alias("d"), F.slice(t, 1, n).alias("t"))
    out = files.select(F.col(file_col).alias("file"), F.posexplode(z).alias("pos", "z"))
    fill = lambda c: F.when(F.length(c) > 0, c).otherwise(F.lit("NaN"))
    return out.select("file", "pos", fill(F.col("z.t")).alias("name"), fill(F.col("z.d")).alias("description"))


# --- S8: list literals written by a CSV sink --------------------------------------

def list_literal(tokens: Column) -> Column:
    """The text form of a token list as the original CSV held it, ``-1`` for none."""
    return F.when(F.size(tokens) > 0,
                  F.concat(F.lit("['"), F.array_join(tokens, "', '"), F.lit("']"))).otherwise(F.lit("-1"))


def parse_list_literal(cell: Column) -> Column:
    """``"['a', 'b']"`` -> ``['a', 'b']``; ``-1`` -> NULL."""
    return F.when(cell != "-1", F.split(F.regexp_replace(cell, "[\\[\\]' ]", ""), ","))
