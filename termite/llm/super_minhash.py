"""Near duplicates by SuperMinHash signatures, banding and union-find.

1. A signature has ``SLOTS`` values.  Every shingle draws its own permutation of
   the slots; in step ``j`` it offers ``j`` plus a fraction to slot ``p[j]``, and
   the least offer stays.  Slots of one shingle get different ranks, so they are
   negatively correlated and estimates vary less than with independent hashes.
   When all slots of a document hold less than ``j``, later steps cannot change
   it and its shingles stop: long documents take a step or two.
2. Bands of ``BAND_SLOTS`` values: two documents meet where a band is equal.
   At a similarity of 0.8 they meet in none of the ``SLOTS // BAND_SLOTS`` bands
   with probability 5e-9.  Documents with equal sets are one *class* and count once.
3. First verification: each class is compared, on full shingle sets, with the
   class that leads most of its bands.  Union-find over the links found makes
   components; near copies are settled here at a cost in proportion to their
   number.
4. Second verification: only bands that still hold two components are open.
   Their members' signatures meet in tasks of bounded size, which name the members
   whose signature agrees well with one of another component and chain such
   components.  The named members of a chain then meet on full sets, in blocks if
   they are many, under a union-find that skips what is joined.

No pairs of members are listed and no member is compared within its component."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termite.llm import words as W
from termite.llm.components import components
from termite.session import scratch_path

SHINGLE = 4
PERCENT = 80
SLOTS = 240
BAND_SLOTS = 5
LED_BANDS = 6            # first verification: bands that a class shares with its leader at least
AGREEING = 0.66          # second: share of equal slots; 0.8 is over five standard deviations above it
TASK_MEMBERS = 1 << 11   # signatures of one side of a task
TASK_BYTES = 16 << 20    # texts that a verifying task holds
BLOCK_BYTES = 2 << 20
SLICE = 1 << 15          # shingles that are signed at a time
BROADCAST_ROWS = 1 << 20
UNSET = np.iinfo(np.uint64).max


def shingle_hashes(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of the distinct shingles of lower-cased texts, ordered
    by both; a text with fewer than ``width`` words has one, its whole sequence."""
    words, offsets = W.split_all(texts, lower=True)
    hashes = W.hash_words(words)
    starts = np.flatnonzero(W.window_starts(offsets, width))
    doc, value = [np.searchsorted(offsets, starts, side="right") - 1], [W.window_hashes(hashes, width)[starts]]
    lengths = np.diff(offsets)
    for k in range(1, width):
        few = np.flatnonzero(lengths == k)
        if len(few):
            doc.append(few)
            value.append(W.mix(W.window_hashes(hashes, k)[offsets[few]] + np.uint64(k)))
    doc, value = np.concatenate(doc), np.concatenate(value)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


def signatures(doc: np.ndarray, value: np.ndarray, n_docs: int, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash values (documents x slots): the step in the high half, the
    fraction in the low half; ``UNSET`` where a document has no shingle."""
    out = np.full((n_docs, slots), UNSET, np.uint64)
    flat = out.reshape(-1)
    for a in range(0, len(doc), SLICE):
        d, v = doc[a:a + SLICE], value[a:a + SLICE]
        permutation = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint32), (len(d), 1))
        open_ = np.arange(len(d))
        first, last = int(d[0]), int(d[-1]) + 1
        for j in range(slots):
            worst = out[first:last].max(axis=1) >> np.uint64(32)
            open_ = open_[worst[d[open_] - first] >= j]
            if len(open_) == 0:
                break
            draw = W.mix(v[open_] + np.uint64((j + 1) * W.BASE & 0xFFFFFFFFFFFFFFFF))
            other = j + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64)
            slot = permutation[open_, other]
            permutation[open_, other] = permutation[open_, j]
            np.minimum.at(flat, d[open_] * slots + slot, (draw >> np.uint64(32)) | np.uint64(j << 32))
    return out


def band_keys(signature: np.ndarray, band_slots: int = BAND_SLOTS) -> np.ndarray:
    """A 64-bit key for each band (documents x bands)."""
    n, slots = signature.shape
    key = np.zeros((n, slots // band_slots), np.uint64)
    parts = signature[:, :key.shape[1] * band_slots].reshape(n, -1, band_slots)
    for k in range(band_slots):
        key = W.mix(key * np.uint64(W.BASE) + parts[:, :, k])
    return W.mix(key ^ W.mix(np.arange(key.shape[1], dtype=np.uint64) + np.uint64(1)))


def _blocks(texts: list[bytes], size: int) -> Iterator[tuple[int, int]]:
    begin = 0
    while begin < len(texts):
        end, held = begin, 0
        while end < len(texts) and (end == begin or held + len(texts[end]) <= size):
            held += len(texts[end])
            end += 1
        yield begin, end
        begin = end


def signed(docs: DataFrame, width: int = SHINGLE, slots: int = SLOTS) -> DataFrame:
    """``(doc_id, text_hash, n_shingles, v, bands, marks)``: for each row of
    ``docs(doc_id, text)`` the size and class of its set, its band keys, and one
    byte of every slot's value; the last three are null without words."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            texts = W.texts_as_bytes(pa.chunked_array([batch.column("text")]))
            for begin, end in _blocks(texts, BLOCK_BYTES):
                doc, value = shingle_hashes(texts[begin:end], width)
                signature = signatures(doc, value, end - begin, slots)
                edges = np.searchsorted(doc, np.arange(end - begin + 1))
                classes = [int.from_bytes(hashlib.blake2b(value[a:b].tobytes(), digest_size=8).digest(), "little", signed=True)
                           if b > a else None for a, b in zip(edges[:-1], edges[1:])]
                keys = band_keys(signature).view(np.int64)
                marks = W.mix(signature).astype(np.uint8)
                rows = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id"), rows.column("text_hash"), pa.array(np.diff(edges), pa.int64()),
                    pa.array(classes, pa.int64()),
                    pa.array([None if c is None else k for c, k in zip(classes, keys)], pa.list_(pa.int64())),
                    pa.array([None if c is None else m.tobytes() for c, m in zip(classes, marks)], pa.binary())],
                    ["doc_id", "text_hash", "n_shingles", "v", "bands", "marks"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, f"doc_id {kind}, text_hash long, n_shingles long, v long, bands array<long>, marks binary")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _small(rows: DataFrame) -> DataFrame:
    """``rows`` of a few numbers each, stored, for a join; sent to all tasks if few."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _linked_to(one: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sorted sets have 100 * intersection >= percent * union with ``one``."""
    sizes = np.array([len(x) for x in others])
    tokens = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, tokens), len(one) - 1)
    same = np.add.reduceat((one[at] == tokens).astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * same >= percent * (len(one) + sizes - same)


def _sets(table: pa.Table, width: int) -> list[np.ndarray]:
    doc, value = shingle_hashes(W.texts_as_bytes(table.column("text")), width)
    return np.split(value, np.searchsorted(doc, np.arange(1, table.num_rows)))


def class_texts(docs: DataFrame, found: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(v, text)``: one text of each class in ``wanted(v)``."""
    rows = found.join(wanted.distinct(), "v", "left_semi").groupBy("v").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("row"))
    rows = _stored(rows.select("v", F.col("row.doc_id").alias("id"), F.col("row.text_hash").alias("hash")), "class-rows")
    texts = docs.select("doc_id", "text").join(
        _small(rows), F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("hash")))
    return _stored(texts.select("v", "text").dropDuplicates(["v"]), "class-texts")


def verify_leaders(pairs: DataFrame, texts: DataFrame, width: int, percent: int, task_bytes: int) -> DataFrame:
    """Those of ``pairs(v, lead)`` that link, as ``(u, v)``.  A leader meets its
    members in tasks of about ``task_bytes`` of text, a copy in each."""
    size = F.octet_length("text") + 64
    members = pairs.join(texts, "v")
    groups = members.groupBy("lead").agg(F.sum(size).alias("w")).withColumn("k", F.ceil(2 * F.col("w") / task_bytes).cast("int"))
    groups = _stored(groups, "leaders")
    bins = max(16, math.ceil(2 * (groups.agg(F.sum("w")).first()[0] or 0) / task_bytes))
    # Large groups have tasks of their own; small ones share a task.
    task = lambda part: F.when(F.col("k") > 1, F.concat_ws(".", "lead", part)).otherwise(
        F.pmod(F.xxhash64("lead"), F.lit(bins)).cast("string"))
    dealt = members.join(groups.select("lead", "k"), "lead").select(
        task(F.pmod(F.xxhash64("v"), F.col("k"))).alias("task"), "lead", "v", "text")
    leads = groups.select("lead", "k").join(texts.withColumnRenamed("v", "lead"), "lead").select(
        "lead", "k", "text", F.explode(F.expr("sequence(0, k - 1)")).alias("part"))
    dealt = dealt.union(leads.select(task(F.col("part")), "lead", "lead", "text"))

    def run(table: pa.Table) -> pa.Table:
        sets = _sets(table, width)
        lead, v = table.column("lead").to_pylist(), table.column("v").to_pylist()
        head = {x: i for i, (x, y) in enumerate(zip(lead, v)) if x == y}
        links = [(v[i], x) for i, x in enumerate(lead) if v[i] != x and _linked_to(sets[head[x]], [sets[i]], percent)[0]]
        return pa.table({"u": pa.array([x for x, _ in links], pa.int64()), "v": pa.array([y for _, y in links], pa.int64())})

    return dealt.groupBy("task").applyInArrow(run, "u long, v long")


def _dealt_blocks(rows: DataFrame, by: list[str], side: Column, weight: Column, limit: int, within: bool) -> DataFrame:
    """``rows``, with a copy for each ``task``, such that in every group of ``by``
    the rows of ``side`` meet all others, and with ``within`` each other too.  Both
    are cut into blocks of about ``limit`` of weight, and a task holds two."""
    blocks = lambda rows: F.greatest(F.lit(1), F.ceil(F.sum(rows) / limit)).cast("int")
    sizes = rows.groupBy(*by).agg(blocks(F.when(side, weight)).alias("s"), blocks(F.when(~side, weight)).alias("o"))
    rows = rows.join(sizes, by)
    block = lambda n: F.pmod(F.xxhash64("v"), n).cast("int")
    each = lambda n, f: F.transform(F.sequence(F.lit(0), F.col(n) - 1), f)
    task = lambda *x: F.concat_ws(".", *by, *x)
    mine = block(F.col("s"))
    tasks = each("o", lambda j: task(mine, F.lit("o"), j))
    if within:
        tasks = F.concat(tasks, each("s", lambda j: task(F.least(mine, j), F.lit("s"), F.greatest(mine, j))))
    others = each("s", lambda i: task(i, F.lit("o"), block(F.col("o"))))
    return rows.withColumn("task", F.explode(F.when(side, tasks).otherwise(others))).drop("s", "o")


def _agreement(a: np.ndarray, b: np.ndarray, least: float) -> Iterator[tuple[int, np.ndarray]]:
    """For some rows of the byte matrix ``a`` at a time: the first one's number, and
    which rows of ``b`` equal each of them in that share of columns."""
    need = math.ceil(least * a.shape[1])
    step = max(1, (1 << 24) // max(1, b.size))
    for i in range(0, len(a), step):
        yield i, (a[i:i + step, None, :] == b[None, :, :]).sum(axis=2, dtype=np.int32) >= need


def _tasks(table: pa.Table) -> Iterator[np.ndarray]:
    """The rows of each task of a table."""
    task = np.unique(table.column("task").to_numpy(zero_copy_only=False), return_inverse=True)[1]
    order = np.argsort(task, kind="stable")
    yield from np.split(order, np.flatnonzero(np.diff(task[order])) + 1)


def _marks(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("marks").to_pylist()), np.uint8).reshape(table.num_rows, -1)


class _Sets:
    """Union-find over small numbers."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return int(i)

    def join(self, i: int, j: int) -> bool:
        a, b = self.find(i), self.find(j)
        self.root[max(a, b)] = min(a, b)
        return a != b

    def roots(self) -> np.ndarray:
        """The root of every number; links end at smaller ones."""
        out = self.root.copy()
        while not np.array_equal(out, out[out]):
            out = out[out]
        return out


def _outside(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` with ``outside``: not of the component that holds most rows of its
    group.  The others need not meet each other."""
    counts = rows.groupBy(by, "c").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy(by).agg(F.max(F.struct("n", "c")).alias("m")).select(by, F.col("m.c").alias("main"))
    return rows.join(main, by).withColumn("outside", F.col("c") != F.col("main")).drop("main")


def meeting_components(members: DataFrame, least: float, task_members: int) -> DataFrame:
    """``(v, c, near)``: the members that agree with one of another component, from
    ``members(key, v, c, marks)``, the bands that hold two components or more.
    ``near``: a component that the member's own is chained to by such agreement."""
    dealt = _dealt_blocks(_outside(members, "key"), ["key"], F.col("outside"), F.lit(1), task_members, True)
    bins = F.pmod(F.xxhash64("task"), F.lit(max(16, math.ceil(dealt.count() / (2 * task_members)))))

    def run(table: pa.Table) -> pa.Table:
        v, c, outside = (table.column(x).to_numpy() for x in ("v", "c", "outside"))
        marks, found = _marks(table), []
        for rows in _tasks(table):
            some = rows[outside[rows]]
            names, label = np.unique(c[rows], return_inverse=True)
            own = np.searchsorted(names, c[some])
            chains, flagged = _Sets(len(names)), np.zeros(len(rows), bool)
            place = np.searchsorted(rows, some)  # rows of a task are in rising order
            for i, near in _agreement(marks[some], marks[rows], least):
                for k, agrees in enumerate(near, i):
                    others = agrees & (label != own[k])
                    if others.any():
                        flagged |= others
                        flagged[place[k]] = True
                        for other in np.unique(label[others]):
                            chains.join(int(own[k]), int(other))
            found.append(np.stack((v[rows], c[rows], names[chains.roots()[label]]), 1)[flagged])
        found = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)
        return pa.table({n: pa.array(found[:, i], pa.int64()) for i, n in enumerate(("v", "c", "near"))})

    return dealt.withColumn("bin", bins).select("bin", "task", "v", "c", "outside", "marks").groupBy("bin").applyInArrow(
        run, "v long, c long, near long").distinct()


def verify_components(members: DataFrame, width: int, percent: int, least: float, task_bytes: int) -> DataFrame:
    """A link ``(u, v)`` for each two components of a chain that members link, if no
    other links join them: from ``members(g, v, c, marks, text)``, ``g`` the chain."""
    weight = F.octet_length("text") + 64
    dealt = _dealt_blocks(_outside(members, "g"), ["g"], F.col("outside"), weight, task_bytes // 2, True)
    total = dealt.agg(F.sum(weight)).first()[0] or 0
    bins = F.pmod(F.xxhash64("task"), F.lit(max(16, math.ceil(2 * total / task_bytes))))

    def run(table: pa.Table) -> pa.Table:
        sets = _sets(table, width)
        v, c, outside = (table.column(x).to_numpy() for x in ("v", "c", "outside"))
        marks, links = _marks(table), []
        for rows in _tasks(table):
            some = rows[outside[rows]]
            label = np.unique(c[rows], return_inverse=True)[1]
            own = label[np.searchsorted(rows, some)]
            joined = _Sets(len(rows))
            for i, near in _agreement(marks[some], marks[rows], least):
                for k, agrees in enumerate(near, i):
                    roots = joined.roots()
                    others = np.flatnonzero(agrees & (roots[label] != roots[own[k]]))
                    if len(others) == 0:
                        continue
                    for j in others[_linked_to(sets[some[k]], [sets[r] for r in rows[others]], percent)]:
                        if joined.join(int(own[k]), int(label[j])):
                            links.append((v[some[k]], v[rows[j]]))
        return pa.table({"u": pa.array([x for x, _ in links], pa.int64()), "v": pa.array([y for _, y in links], pa.int64())})

    return dealt.withColumn("bin", bins).select("bin", "task", "v", "c", "outside", "marks", "text").groupBy("bin").applyInArrow(
        run, "u long, v long")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, slots: int = SLOTS,
                    least: float = AGREEING, task_members: int = TASK_MEMBERS, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of
    ``docs(doc_id, text)``; other columns are not read.

    A set holds the distinct shingles of ``width`` words (A-Z lower-cased) of the
    whole text, or the whole sequence of a shorter one.  Documents with
    ``100 * intersection >= percent * union`` link; ``component_id`` is the least
    id reachable and ``kept`` says whether it is the row's own.  A text that is
    null, empty or white space has no set and is its own component, as is any
    document without a link; a null ``doc_id`` without a link keeps a null
    component and stays.  Rows with equal sets link, repeated rows among them.
    An empty table gives an empty result.  Shingles and classes are told apart by
    64-bit hashes."""
    found = _stored(signed(docs, width, slots), "signatures")
    held = found.where("v is not null").select("v", F.explode("bands").alias("key"))
    shared = held.groupBy("key").agg(F.min("v").alias("lead"), F.max("v").alias("last")).where("lead < last")
    shared = _small(_stored(shared.select("key", "lead"), "shared-bands"))
    meeting = _stored(held.join(shared, "key").distinct(), "meeting")
    led = meeting.where("v <> lead").groupBy("v", "lead").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LED_BANDS)
    best = _stored(led.groupBy("v").agg(F.max(F.struct("n", "lead")).alias("m")).select("v", F.col("m.lead").alias("lead")), "leaders")
    texts = class_texts(docs, found, best.select("v").union(best.select("lead")))
    links = _stored(verify_leaders(best, texts, width, percent, task_bytes), "links")
    joined = components(links).withColumnRenamed("component", "c")

    labels = meeting.select("v").distinct().join(joined, "v", "left").withColumn("c", F.coalesce("c", "v"))
    now = _stored(meeting.select("key", "v").join(labels, "v"), "members")
    open_ = now.groupBy("key").agg(F.min("c").alias("a"), F.max("c").alias("b")).where("a < b").select("key")
    now = now.join(open_, "key")
    marks = found.join(now.select("v").distinct(), "v", "left_semi").groupBy("v").agg(F.first("marks").alias("marks"))
    marks = _stored(marks, "marks")
    near = _stored(meeting_components(now.join(marks, "v"), least, task_members), "near-components")
    if near.limit(1).count():
        chains = components(near.select(F.col("c").alias("u"), F.col("near").alias("v"))).select(
            F.col("v").alias("c"), F.col("component").alias("g"))
        rows = near.select("v", "c").distinct().join(chains, "c").join(marks, "v").join(
            class_texts(docs, found, near.select("v")), "v")
        second = verify_components(rows.select("g", "v", "c", "marks", "text"), width, percent, least, task_bytes)
        joined = components(links.union(second)).withColumnRenamed("component", "c")

    roots = found.where("v is not null").groupBy("v").agg(F.min("doc_id").alias("root"))
    roots = roots.join(joined, "v", "left").withColumn("c", F.coalesce("c", "v"))
    answer = roots.join(roots.groupBy("c").agg(F.min("root").alias("least")), "c").select("v", "least")
    out = found.select("doc_id", "n_shingles", "v").join(answer, "v", "left").withColumn(
        "component_id", F.coalesce("least", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
