"""Removal of benchmark text from documents (DataFrame functions only).

The word windows of all benchmark items form a hash set that is broadcast after
its size is checked; every window of every document probes it.  The keys are the
windows' words themselves, so a hash hit is verified by comparing them.  Only
hits leave the scan's stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termite.llm.columns import under_other_names

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A word character is a digit, a letter a-z or any character beyond ASCII.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
WORD_WITH_BREAKS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
WINDOW = 10
BROADCAST_BYTES = 64 << 20


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased; ``lower`` where the text is ASCII, as it is faster."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAKS + "+"), "")


def _windows(ws: Column, length: int) -> Column:
    """``(pos, len, win)`` of each window of ``length`` words, pos from 1."""
    last = F.size(ws) - length + 1
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.struct(
        i.alias("pos"), F.lit(length).alias("len"),
        F.array_join(F.slice(ws, i, length), " ").alias("win")))).otherwise(
        F.array().cast("array<struct<pos:int,len:int,win:string>>"))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(win, items)``: each distinct window with the ids, as strings, of the
    items that hold it.  An item of fewer words is one window; one without words
    has none; a null id counts as the empty string."""
    ws = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                          words(F.col("text")).alias("ws")).where(F.size("ws") > 0)
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("ws") - window + 1)))
    one = ws.select("item", "ws", start.alias("i")).select(
        "item", F.array_join(F.slice("ws", F.col("i"), window), " ").alias("win"))
    return one.groupBy("win").agg(F.collect_set("item").alias("items"))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` less ``text``, one row for each of its rows, with ``n_words``,
    ``n_hit`` (words inside an occurring window), ``items`` (sorted ids of the
    items found) and ``covered`` (their word positions, sorted, from 1), which
    replace columns of these names.

    A null, empty or wordless text has no words and no hits.  Repeated rows are
    separate documents.  Empty tables give no rows, or rows without hits."""
    docs = docs.drop("n_words", "n_hit", "items", "covered")
    wins = item_windows(benchmark, window).cache()
    try:
        size, *lengths = wins.agg(
            F.sum(F.octet_length("win") + F.size("items") * 16 + 48),
            F.collect_set(F.size(F.split("win", " ")))).first()
        lengths = sorted(lengths[0])  # at most ``window`` values
    finally:
        wins.unpersist()
    side = F.broadcast(wins) if (size or 0) <= BROADCAST_BYTES else wins
    others = [c for c in docs.columns if c != "text"]
    row = F.struct(*[F.col(f"`{c}`") for c in others]).alias("doc")
    ws = docs.select(row, F.monotonically_increasing_id().alias("row"), words(F.col("text")).alias("ws"))
    head = F.array(F.struct(F.lit(0).alias("pos"), F.lit(0).alias("len"), F.lit(None).cast("string").alias("win")))
    probe = ws.select("doc", "row", F.size("ws").cast("long").alias("n_words"),
                      F.explode(F.concat(head, *[_windows(F.col("ws"), n) for n in lengths])).alias("w"))
    found = probe.select("doc", "row", "n_words", "w.*").join(side, "win", "left").where("pos = 0 or items is not null")
    place = F.when(F.col("pos") > 0, F.sequence("pos", F.col("pos") + F.col("len") - 1))
    return found.groupBy("row").agg(
        F.first("doc").alias("doc"), F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(place)))).alias("covered"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    ).select(*[F.col(f"doc.`{c}`").alias(c) for c in others], "n_words",
             F.size("covered").cast("long").alias("n_hit"), "items", "covered")


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents",
                  window: int = WINDOW) -> DataFrame:
    """``docs``, all columns, without benchmark text: whole documents with a hit
    (``remove="documents"``), or the hit words and what separates them from the
    next word (``remove="spans"``).

    Rows with the same id and text get the same decision.  Documents without a
    hit come out unchanged, those with a null text too."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove: documents or spans, not {remove!r}")
    return under_other_names(docs, ("doc_id", "text"), lambda d: _decontaminate(d, benchmark, remove, window))


def _decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str, window: int) -> DataFrame:
    key = [F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__hash")]
    found = hits(docs.select(*key, "text"), benchmark, window).where("n_hit > 0").select(
        "__id", "__hash", F.col("covered").alias("__cut")).dropDuplicates(["__id", "__hash"])
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    if remove == "documents":
        return docs.join(found, same, "left_anti")
    joined = docs.join(found, same, "left")
    lead = F.regexp_extract("text", "^" + BREAKS.replace(r"\x60", r"\x40\x5B-\x60") + "*", 0)
    pieces = F.regexp_extract_all("text", F.lit(WORD_WITH_BREAKS), F.lit(0))
    kept = F.array_join(F.filter(pieces, lambda p, i: ~F.array_contains(F.col("__cut"), i + 1)), "")
    text = F.when(F.col("__cut").isNull(), F.col("text")).otherwise(F.concat(lead, kept))
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row a document: words, hit words, and a digest of the items found."""
    return hits(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
