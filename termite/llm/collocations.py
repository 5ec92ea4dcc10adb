"""Phrase collocations by a multikey three-way quicksort of suffix pointers.

1. The words of each language are counted over the whole corpus.
2. A suffix is a place in a text with the next ``max_words`` words, cut at the end
   of its piece and, where the list of frequent words is short enough to be sent
   to all tasks, at the first infrequent word, which no frequent phrase holds.
   Blocks of documents reduce their suffixes to distinct ones with counts and
   route them by their leading words.
3. One leading word decides the route unless it begins more suffixes than a task
   holds; then two words do, and so on.  The words and phrases that begin too
   many (the *hot* ones) are counted first, a length at a time; as each begins
   more than ``task_suffixes`` suffixes there are few of them.
4. A task sorts its suffix pointers by multikey three-way quicksort down to
   ``max_words`` words.  The partition that equals the pivot at some depth is a
   phrase and its size is the phrase's count; a partition smaller than
   ``min_count`` is abandoned unsorted.
5. Joins give each phrase the counts of its parts.

Words are told apart by 63 bits of a hash of language and word (one wrong pair is
expected among 4 * 10**9 distinct words)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termite.llm import words as W
from termite.session import scratch_path

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
UNKNOWN = "und"
TASK_SUFFIXES = 1 << 20       # suffixes that one leading phrase may send to a task
MOST_HOT = 1 << 20            # so many hot phrases of a length at most: above that a task holds more
LISTED_WORDS = (1 << 21) - 2  # frequent words that are sent to all tasks, 8 bytes each
BLOCK_BYTES = 8 << 20
RANKED_IN_A_TASK = 1 << 17

END = -1
BREAK = b"\n"
# Piece ends become line feeds and tabs spaces; bytes of multi-byte characters are never touched.
SEPARATORS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")


def blocks(parts: Iterator[pa.RecordBatch], size: int = BLOCK_BYTES) -> Iterator[tuple[list[bytes], list[str]]]:
    """Texts and languages of the batches' rows, about ``size`` bytes at a time; a
    longer text comes whole."""
    texts, langs, held = [], [], 0
    for batch in parts:
        for text, lang in zip(W.texts_as_bytes(pa.chunked_array([batch.column("text")])), batch.column("lang").to_pylist()):
            texts.append(text)
            langs.append(UNKNOWN if lang is None else lang)
            held += len(text)
            if held >= size:
                yield texts, langs
                texts, langs, held = [], [], 0
    if texts:
        yield texts, langs


def read_words(texts: list[bytes], langs: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """All words, line feeds between pieces among them, with their number (``END``
    for a line feed) and document, and the places of both in the list of words."""
    words: list[bytes] = []
    offsets = [0]
    for text in texts:
        words += text.lower().translate(SEPARATORS).replace(BREAK, b" \n ").split(b" ")
        words.append(BREAK)
        offsets.append(len(words))
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    hashes = W.hash_words(words)
    at = np.flatnonzero(hashes != np.uint64(xxhash.xxh3_64_intdigest(b"")))
    hashes, doc = hashes[at], doc[at]
    number = number_words(hashes, salts_of(langs)[doc])
    number[hashes == np.uint64(xxhash.xxh3_64_intdigest(BREAK))] = END
    return words, number, doc, at


def salts_of(langs: list[str]) -> np.ndarray:
    salt = {x: xxhash.xxh3_64_intdigest(x.encode()) for x in set(langs)}
    return W.mix(np.array([salt[x] for x in langs], np.uint64))


def number_words(hashes: np.ndarray, salts: np.ndarray) -> np.ndarray:
    return (W.mix(hashes ^ salts) >> np.uint64(1)).astype(np.int64)


def count_words(docs: DataFrame) -> DataFrame:
    """``(lang, word, f)`` of ``docs(text, lang)``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, langs in blocks(parts):
            words, number, doc, at = read_words(texts, langs)
            real = np.flatnonzero(number != END)
            _, first, count = np.unique(number[real], return_index=True, return_counts=True)
            first = real[first]
            yield pa.RecordBatch.from_arrays([
                pa.array([langs[i] for i in doc[first]], pa.string()),
                pa.array([words[i].decode() for i in at[first]], pa.string()), pa.array(count, pa.int64())], ["lang", "word", "f"])

    found = docs.select("text", "lang").mapInArrow(run, "lang string, word string, f long")
    return found.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def with_codes(words: DataFrame) -> DataFrame:
    """``(lang, word, f, code)``: the numbers that stand for the words."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            hashes = W.hash_words([x.encode() for x in batch.column("word").to_pylist()])
            code = number_words(hashes, salts_of(batch.column("lang").to_pylist()))
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(code, pa.int64())], names=["lang", "word", "f", "code"])

    return words.mapInArrow(run, "lang string, word string, f long, code long")


class HotPhrases:
    """The hot phrases of one length: numbered pairs of the number of the phrase
    without its last word and that word."""

    def __init__(self, before: np.ndarray, last: np.ndarray):
        self.words = np.unique(last)
        self.pairs = np.sort(before * len(self.words) + np.searchsorted(self.words, last))

    def find(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The number of each pair, -1 where it is not hot; ``before`` may be -1."""
        at = np.minimum(np.searchsorted(self.words, last), len(self.words) - 1)
        pair = before * len(self.words) + at
        out = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((before >= 0) & (self.words[at] == last) & (self.pairs[out] == pair), out, -1)


class Suffixes:
    """Reads the suffixes of blocks of documents.  ``listed``: the sorted numbers
    of all frequent words, whose places there stand for them, or None, where all
    words count as frequent and stand for themselves."""

    def __init__(self, listed: np.ndarray | None, max_words: int):
        self.listed, self.max_words = listed, max_words
        small = listed is not None and len(listed) < (1 << 16) - 1
        self.kind = np.dtype("<u2" if small else "<u4" if listed is not None else "<u8")

    def codes(self, number: np.ndarray) -> np.ndarray:
        if self.listed is None:
            return number
        if not len(self.listed):
            return np.full(len(number), END)
        at = np.minimum(np.searchsorted(self.listed, number), len(self.listed) - 1)
        return np.where(self.listed[at] == number, at, END)

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        return codes if self.listed is None else self.listed[codes]

    def columns(self, texts: list[bytes], langs: list[str]) -> list[np.ndarray]:
        """The first, second, ... words of all suffixes of two words or more."""
        code = np.append(self.codes(read_words(texts, langs)[1]), np.full(self.max_words, END))
        at = np.flatnonzero((code[:-1] != END) & (code[1:] != END))
        out = [code[at]]
        for k in range(1, self.max_words):
            out.append(np.where(out[-1] == END, END, code[at + k]))
        return out

    def distinct(self, columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
        """The distinct rows of the columns, sorted, and their counts."""
        keys = columns
        if self.listed is not None:  # three words of 21 bits fit into a key
            keys = [sum((c + 1) << (21 * (2 - i)) for i, c in enumerate(columns[k:k + 3])) for k in range(0, len(columns), 3)]
        order = np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        first = np.ones(len(order), bool)
        if len(order):
            first[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        at = np.flatnonzero(first)
        return [c[order[at]] for c in columns], np.diff(np.append(at, len(order)))

    def pack(self, columns: list[np.ndarray]) -> bytes:
        """The columns, compressed, each by the first, second, ... bytes of its codes:
        those repeat more than the codes do.  ``END`` becomes the largest value."""
        flat = np.stack([c.astype(self.kind) for c in columns])
        planes = flat.view(np.uint8).reshape(*flat.shape, self.kind.itemsize).transpose(0, 2, 1)
        return pa.compress(planes.tobytes(), "zstd", asbytes=True)

    def unpack(self, data: list[bytes], sizes: list[int]) -> list[np.ndarray]:
        parts = []
        for packed, n in zip(data, sizes):
            whole = pa.decompress(packed, n * self.max_words * self.kind.itemsize, "zstd", asbytes=True)
            planes = np.frombuffer(whole, np.uint8).reshape(self.max_words, self.kind.itemsize, n)
            parts.append(np.ascontiguousarray(planes.transpose(0, 2, 1)).view(self.kind)[:, :, 0])
        whole = np.concatenate(parts, axis=1)
        return [np.where(c == np.iinfo(self.kind).max, END, c.astype(np.int64)) for c in whole]


def route_depth(columns: list[np.ndarray], hot: list[HotPhrases]) -> tuple[np.ndarray, np.ndarray]:
    """How many leading words route each suffix, and a hash of them."""
    n = len(columns[0])
    depth = np.ones(n, np.int64)
    before = np.zeros(n, np.int64)
    key = columns[0].astype(np.uint64)
    for k, phrases in enumerate(hot):
        before = np.where(depth == k + 1, phrases.find(before, columns[k]), -1)
        deeper = before >= 0
        depth[deeper] += 1
        key[deeper] = W.mix(before[deeper].astype(np.uint64) + np.uint64(k << 40)) ^ columns[k + 1][deeper].astype(np.uint64)
    return depth, W.mix(key)


def hot_phrases(docs: DataFrame, suffixes: Suffixes, hot: list[HotPhrases], more_than: int) -> DataFrame:
    """``(codes, f)`` of the phrases one word longer than the last of ``hot`` that
    begin with one of those and occur more than ``more_than`` times."""
    length = len(hot) + 1

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, langs in blocks(parts):
            columns = suffixes.columns(texts, langs)
            keep = (route_depth(columns, hot)[0] == length) & (columns[length - 1] != END)
            rows, count = suffixes.distinct([c[keep] for c in columns[:length]])
            codes = suffixes.numbers(np.stack(rows, 1)).ravel()
            yield pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(pa.array(np.arange(len(count) + 1) * length, pa.int32()), pa.array(codes, pa.int64())),
                pa.array(count, pa.int64())], ["codes", "f"])

    found = docs.select("text", "lang").mapInArrow(run, "codes array<long>, f long")
    return found.groupBy("codes").agg(F.sum("f").alias("f")).where(F.col("f") > more_than)


def frequent_prefixes(columns: list[np.ndarray], weights: np.ndarray, min_count: int) -> list[tuple[int, int, int]]:
    """``(row, length, count)`` of every sequence of first words that rows with a
    total weight of ``min_count`` or more begin with; ``row`` is one of these.

    Multikey three-way quicksort of the row pointers: the pointers of a partition
    agree on the words before its depth and are split by a pivot of the words
    there.  Only partitions that are heavy enough are sorted on."""
    found, stack = [], [(np.arange(len(weights)), 0)]
    while stack:
        pointers, depth = stack.pop()
        if len(pointers) == 0:
            continue
        keys = columns[depth][pointers]
        pivot = np.sort(keys[[0, len(keys) // 2, -1]])[1]
        less, more = keys < pivot, keys > pivot
        equal = pointers[~(less | more)]
        total = int(weights[equal].sum())
        if pivot != END and total >= min_count:
            found.append((int(equal[0]), depth + 1, total))
            if depth + 1 < len(columns):
                stack.append((equal, depth + 1))
        for side in (pointers[less], pointers[more]):
            if weights[side].sum() >= min_count:
                stack.append((side, depth))
    return found


def count_phrases(docs: DataFrame, suffixes: Suffixes, hot: list[HotPhrases], routes: int, min_count: int) -> DataFrame:
    """``(codes, f)`` of the phrases of two words or more that are not hot and
    occur ``min_count`` times or more."""

    def send(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, langs in blocks(parts):
            columns, count = suffixes.distinct(suffixes.columns(texts, langs))
            depth, key = route_depth(columns, hot)
            group = (key % np.uint64(routes)).astype(np.int64) * (suffixes.max_words + 1) + depth
            order = np.argsort(group, kind="stable")
            names, first = np.unique(group[order], return_index=True)
            ends = np.append(first[1:], len(order))
            rows = [order[a:b] for a, b in zip(first, ends)]
            yield pa.RecordBatch.from_arrays([
                pa.array(names // (suffixes.max_words + 1), pa.int64()), pa.array(names % (suffixes.max_words + 1), pa.int32()),
                pa.array([suffixes.pack([c[r] for c in columns]) for r in rows], pa.binary()),
                pa.array([count[r].astype("<u4").tobytes() for r in rows], pa.binary())], ["route", "depth", "codes", "counts"])

    def sort(table: pa.Table) -> pa.Table:
        counts = [np.frombuffer(x, "<u4") for x in table.column("counts").to_pylist()]
        sizes = [len(x) for x in counts]
        depth = np.repeat(table.column("depth").to_numpy(), sizes)
        columns = suffixes.unpack(table.column("codes").to_pylist(), sizes)
        found = frequent_prefixes(columns, np.concatenate(counts).astype(np.int64), min_count)
        # Shorter phrases than the words of a route are hot: only some of their suffixes are here.
        found = [(row, k, f) for row, k, f in found if k >= max(2, depth[row])]
        codes = [suffixes.numbers(np.array([c[row] for c in columns[:k]])) for row, k, f in found]
        return pa.table({"codes": pa.array(codes, pa.list_(pa.int64())), "f": pa.array([f for *_, f in found], pa.int64())})

    sent = docs.select("text", "lang").mapInArrow(send, "route long, depth int, codes binary, counts binary")
    return sent.groupBy("route").applyInArrow(sort, "codes array<long>, f long")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                     task_suffixes: int = TASK_SUFFIXES, listed_words: int = LISTED_WORDS) -> tuple[DataFrame, DataFrame]:
    """``(lang, word, f, code, n)`` of the words and ``(codes, f)`` of the phrases of
    2 to ``max_words`` words that occur ``min_count`` times or more in their
    language; ``n`` counts its words, and a phrase is the list of its words' codes."""
    words = _stored(count_words(docs), "words")
    totals = _stored(words.groupBy("lang").agg(F.sum("f").alias("n")), "languages")
    total = totals.agg(F.sum("n")).first()[0] or 0
    words = _stored(with_codes(words.where(F.col("f") >= min_count)).join(totals, "lang"), "frequent-words")
    listed = None
    if words.count() <= listed_words:
        listed = np.unique(words.select("code").toArrow().column("code").to_numpy())
    suffixes = Suffixes(listed, max_words)
    more_than = max(task_suffixes, min_count, math.ceil(total / MOST_HOT))
    hot: list[HotPhrases] = []
    counted = []
    longest = words.where(F.col("f") > more_than).select(F.array("code").alias("codes"))
    while len(hot) < max_words - 1:
        rows = longest.select("codes").toArrow().column("codes")
        if len(rows) == 0:
            break
        codes = suffixes.codes(rows.combine_chunks().flatten().to_numpy()).reshape(len(rows), -1)
        before = np.zeros(len(rows), np.int64)
        for k, phrases in enumerate(hot):
            before = phrases.find(before, codes[:, k])
        hot.append(HotPhrases(before, codes[:, -1]))
        if len(hot) == max_words - 1:
            break
        longest = _stored(hot_phrases(docs, suffixes, list(hot), more_than), "hot-phrases")
        counted.append(longest)
    routes = max(16, math.ceil(2 * total / more_than))
    phrases = count_phrases(docs, suffixes, hot, routes, min_count)
    for rows in counted:
        phrases = phrases.union(rows.where(F.col("f") >= min_count))
    return words, _stored(phrases, "phrases")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int | None = TOP,
                 **how) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top``
    (None: all) phrases by score, count and phrase; ``docs`` has ``text`` and
    ``lang`` among its columns.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and
    those into words at spaces and tabs.  ``n`` counts the language's words and
    ``a`` the phrase, overlapping occurrences too, inside pieces; ``l`` and ``r``
    count the two parts of the cut with the least ``score`` = floor(1000 * a * n /
    (l * r)), of equal ones the first.  A phrase inside a longer one that is as
    frequent is left out.  A null language is ``und``; a null, empty or
    white-space text has no words; repeated rows count each; an empty table gives
    an empty result."""
    known, phrases = frequent_phrases(docs, min_count, max_words, **how)
    parts = phrases.union(known.select(F.array("code"), "f"))
    cuts = phrases.select("codes", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size(codes) - 1)")).alias("k"))
    cuts = cuts.select("*", F.expr("slice(codes, 1, k)").alias("left"), F.expr("slice(codes, k + 1, size(codes))").alias("right"))
    cuts = cuts.join(parts.toDF("left", "l"), "left").join(parts.toDF("right", "r"), "right")
    cuts = _stored(cuts, "cuts")
    # A phrase that a longer one of its frequency holds is the start or the rest of one that is a word longer.
    inside = cuts.where("k = size(codes) - 1 and k > 1 and l = a").select(F.col("left").alias("codes")).union(
        cuts.where("k = 1 and size(codes) > 2 and r = a").select("right"))
    langs = known.select(F.col("code").alias("first"), "lang", "n")
    scored = cuts.join(inside.distinct(), "codes", "left_anti").withColumn("first", F.element_at("codes", 1)).join(langs, "first")
    exact = [F.col(c).cast("decimal(38,0)").alias(c) for c in ("a", "n", "l", "r")]
    scored = scored.select("lang", "codes", "k", *exact).withColumn("score", F.expr("(1000 * a * n) div (l * r)"))
    best = scored.groupBy("lang", "codes", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "codes", *[F.col(c).cast("long").alias(c) for c in ("a", "n")], F.col("cut.score").alias("score"),
                       *[F.col(f"cut.{c}").cast("long").alias(c) for c in ("l", "r")])
    spelt = best.select("*", F.posexplode("codes").alias("at", "code")).join(known.select("code", "word"), "code")
    spelt = spelt.groupBy("lang", "codes", "a", "l", "r", "n", "score").agg(
        F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    spelt = spelt.withColumn("phrase", F.array_join("words.word", " "))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    if top is not None:  # a language may hold most phrases: parts of it are ranked first
        parts_of = math.ceil(max(1, phrases.count()) / RANKED_IN_A_TASK)
        spelt = spelt.withColumn("part", F.pmod(F.xxhash64("codes"), F.lit(parts_of)))
        near = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
        spelt = spelt.withColumn("near", near).where(F.col("near") <= top)
    ranked = spelt.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
