"""Similarity join of documents on their word shingles, by signature trees.

1. Every chunk of documents makes its shingle sets; the corpus counts how many
   documents hold each shingle (:mod:`termite.llm.exchange`).
2. A shingle that only one document holds links nothing.  A document with more
   than a quarter of such shingles has no partner and is done.  Equal sets
   become one class.
3. Two linked sets share one of the first ``n - ceil(0.75 n) + 1`` shingles in
   the order from rare to frequent.  Classes that meet on such a shingle, chained
   through others, form a group; only inside a group can links exist.
4. Groups up to a weight are joined whole in one task, by dual traversal of a
   signature tree (:mod:`termite.llm.signature_tree`).  A heavier group, such as
   thousands of near copies, is cut into blocks by size band and hash: each block
   is joined with the first block of its own and of the next band, and after
   that only members outside the group's largest class are joined with the
   blocks of the neighbouring bands.  Where that would deal many copies of a
   member, as in documents of template passages chained through one another, the
   group falls into meeting lists instead: the members that hold one of those
   first shingles, unless they are linked already; lists inside another are left out.
5. The links found, a spanning forest of all links, give the components.

No pairs are listed, so near copies cost in proportion to their number."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termite.llm import exchange as X
from termite.llm import words as W
from termite.llm.columns import under_other_names
from termite.llm.components import components
from termite.llm.signature_tree import links
from termite.session import scratch_path

SHINGLE = 5
PERCENT = 75
TASK_WEIGHT = 1 << 20  # shingles that one task joins
MEMBER_WEIGHT = 64     # what a member adds to that beside its shingles
BROADCAST_ROWS = 1 << 20   # decisions of 24 bytes that are sent to all tasks; more are joined by a shuffle
BLOCK_COPIES = 4  # copies of a member, on average, above which a heavy group may fall into meeting lists
BAND = math.log(1.34)  # sets whose sizes differ by 4/3 lie at most one band apart


def _shingles(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Document index and hash of the distinct shingles, ordered by both."""
    words, offsets = W.split_all(W.texts_as_bytes(table.column("text")), lower=True)
    hashes = W.hash_words(words)
    starts = np.flatnonzero(W.window_starts(offsets, width))
    doc = np.searchsorted(offsets, starts, side="right") - 1
    value = W.window_hashes(hashes, width)[starts]
    lengths = np.diff(offsets)
    short = np.flatnonzero((lengths > 0) & (lengths < width))
    whole = [W.mix(W.window_hashes(hashes[offsets[i]:offsets[i + 1]], int(lengths[i])) + np.uint64(lengths[i]))[0]
             for i in short]
    doc = np.concatenate((doc, short))
    value = np.concatenate((value, np.array(whole, np.uint64)))
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


def _least_overlap(n, percent: int):
    return (percent * n + 99) // 100


def shingle_sets(docs: DataFrame, width: int, percent: int, chunk_bytes: int) -> DataFrame:
    """``(doc_id, text_hash, n, set_id, keys)``: size and id of each document's set; for a
    document that may have a partner, its shingles that others hold too, from
    rare to frequent, else null."""
    chunks, size = X.in_chunks(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), chunk_bytes)

    def keys_of(table: pa.Table):
        return np.unique(_shingles(table, width)[1], return_counts=True)

    def describe(table: pa.Table, counts: np.ndarray) -> pa.Table:
        doc, value = _shingles(table, width)
        held = counts[np.unique(value, return_inverse=True)[1]]
        edges = np.searchsorted(doc, np.arange(table.num_rows + 1))
        by_rarity = np.lexsort((value, held, doc))
        signed = value.view(np.int64)
        ids, keys = [], []
        for a, b in zip(edges[:-1], edges[1:]):
            n = int(b - a)
            ids.append(int.from_bytes(hashlib.blake2b(value[a:b].tobytes(), digest_size=8).digest(), "little", signed=True)
                       if n else None)
            mine = by_rarity[a:b]
            mine = mine[held[mine] > 1]
            keys.append(signed[mine] if n and len(mine) >= _least_overlap(n, percent) else None)
        return pa.table({"doc_id": table.column("doc_id"), "text_hash": table.column("text_hash"), "n": pa.array(np.diff(edges), pa.int64()),
                         "set_id": pa.array(ids, pa.int64()), "keys": pa.array(keys, pa.list_(pa.int64()))})

    # The counts only order and exclude shingles; five bytes and the bucket's bits tell enough apart.
    counts = X.corpus_counts(chunks, keys_of, X.bucket_bits(size), width=5)
    kind = dict(docs.dtypes)["doc_id"]
    return X.with_counts(chunks, counts, describe, f"doc_id {kind}, text_hash long, n long, set_id long, keys array<long>")


def _join_tasks(members: DataFrame, percent: int) -> DataFrame:
    """Edges ``(u, v)`` among ``members(task, part, v, label, n, keys)``; each
    ``part`` of a task is joined in itself."""

    def run(table: pa.Table) -> pa.Table:
        part = np.unique(table.column("part").to_numpy(), return_inverse=True)[1]
        table = table.take(pa.array(np.argsort(part, kind="stable")))
        part = np.sort(part)
        ids = table.column("v").to_numpy()
        label = table.column("label").to_numpy()
        sizes = table.column("n").to_numpy()
        keys = table.column("keys").combine_chunks()
        offsets = keys.offsets.to_numpy().astype(np.int64)
        tokens = keys.values.to_numpy()
        out = label.copy()
        cut = np.flatnonzero(np.diff(part, prepend=-1, append=part[-1] + 1 if len(part) else 0))
        for a, b in zip(cut[:-1], cut[1:]):
            lo, hi = offsets[a], offsets[b]
            out[a:b] = links(sizes[a:b], offsets[a:b + 1] - lo, tokens[lo:hi], label[a:b], percent)
        new = np.unique(np.stack((label, out), 1)[label != out], axis=0)
        return pa.table({"u": pa.array(new[:, 0], pa.int64()), "v": pa.array(new[:, 1], pa.int64())})

    return members.groupBy("task").applyInArrow(run, "u long, v long")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _leading(percent: int) -> Column:
    """The shingles on one of which two linked sets meet.  A set of n has n -
    size(keys) shingles of its own; they come first in its order."""
    return F.expr(f"slice(keys, 1, cast(size(keys) - ({percent} * n + 99) div 100 + 1 as int))")


def _bands(heavy: DataFrame, weight: Column, task_weight: int) -> DataFrame:
    """For each group and size band: blocks ``k`` of all members, blocks ``s`` of
    ``outside`` members, the same of the bands around, and the copies that the
    second round would deal."""
    half = task_weight / 2
    bands = heavy.groupBy("g", "band").agg(
        F.ceil(F.sum(weight) / half).alias("k"),
        F.ceil(F.sum(F.when(F.col("outside"), weight).otherwise(0)) / half).alias("s"),
        F.count(F.lit(1)).alias("c"), F.count(F.when(F.col("outside"), 1)).alias("o"))
    around = bands.select("g", (F.col("band") + 1).alias("band"), F.col("k").alias("k_before"), F.col("s").alias("s_before"))
    after = bands.select("g", (F.col("band") - 1).alias("band"), F.col("k").alias("k_after"), F.col("s").alias("s_after"))
    bands = bands.join(around, ["g", "band"], "left").join(after, ["g", "band"], "left").na.fill(0)
    return bands.withColumn("copies", F.expr("o * (k_before + k + k_after) + c * (s_before + s + s_after)"))


def _with_outside(members: DataFrame) -> DataFrame:
    """``members`` of groups ``g`` with ``outside``: not in the group's largest class."""
    main = members.groupBy("g", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("g").agg(
        F.max(F.struct("c", "label")).alias("m")).select("g", F.col("m.label").alias("main"))
    return members.drop("outside").join(main, "g").withColumn("outside", F.col("label") != F.col("main")).drop("main")


def _second_round(now: DataFrame, weight: Column, percent: int, task_weight: int) -> DataFrame:
    """Members of heavy groups, with their labels of the first round, dealt to
    tasks and their parts: by blocks, or by meeting lists where those deal fewer
    copies.  Either way meets every pair of different labels that may link.

    A member is in at most as many lists as it has leading shingles, however many
    members the group has.  Only a list above ``task_weight`` is cut into blocks."""
    columns = ["task", "part", "v", "label", "n", "keys"]
    groups = _stored(_bands(now, weight, task_weight).groupBy("g").agg(
        F.sum("copies").alias("copies"), F.sum("c").alias("c")), "heavy-groups")
    many = groups.where(F.col("copies") > BLOCK_COPIES * F.col("c"))
    if not many.limit(1).count():
        return _heavy_tasks(now, weight, False, task_weight).select(*columns)
    held = now.join(many.select("g"), "g", "left_semi").select(
        "g", "v", "label", weight.alias("w"), F.explode(_leading(percent)).alias("key"))
    # Shingles of one passage have the same holders: of their lists one is kept.
    lists = held.groupBy("g", "key").agg(
        F.count(F.lit(1)).alias("c"), F.sum("w").alias("w"), F.min("label").alias("low"), F.max("label").alias("high"),
        F.bit_xor(F.xxhash64("v")).alias("x"), F.bit_xor(F.xxhash64("v", F.lit(1))).alias("y")).where("low < high")
    lists = lists.groupBy("g", "c", "w", "x", "y").agg(F.min("key").alias("key"))
    # A list whose holders all have the same next larger list lies inside that one.
    larger = F.lead("key").over(Window.partitionBy("v").orderBy("c", "key"))
    inside = _stored(held.join(lists.select("key", "c"), "key").withColumn("larger", larger), "meetings")
    inside = inside.groupBy("key").agg(F.min("larger").alias("a"), F.max("larger").alias("b"),
                                       F.count_if(F.col("larger").isNull()).alias("none")).where("none = 0 and a = b")
    lists = _stored(lists.join(inside, "key", "left_anti"), "meeting-lists")
    by_lists = _stored(lists.groupBy("g").agg(F.sum("c").alias("by_lists")).join(many, "g", "right").na.fill(0).where(
        "by_lists < copies").select("g"), "listed-groups")
    met = held.join(lists.join(by_lists, "g", "left_semi").select("key", F.col("w").alias("list_w")), "key").select(
        "v", F.col("key").alias("list"), "list_w")
    listed = now.drop("g", "outside").join(met, "v").withColumnRenamed("list", "g")
    small = listed.where(F.col("list_w") <= task_weight)
    total = lists.where(F.col("w") <= task_weight).agg(F.sum("w")).first()[0] or 0
    bins = max(1, math.ceil(2 * total / task_weight))
    small = small.withColumn("part", F.col("g")).withColumn(
        "task", F.concat(F.lit("list|"), F.pmod(F.xxhash64("g"), F.lit(bins))))
    dealt = _heavy_tasks(now.join(by_lists, "g", "left_anti"), weight, False, task_weight).select(*columns).union(
        small.select(*columns))
    if lists.where(F.col("w") > task_weight).limit(1).count():
        large = _with_outside(listed.where(F.col("list_w") > task_weight).drop("list_w"))
        large = _heavy_tasks(large, weight, False, task_weight).withColumn("task", F.concat(F.lit("long|"), "task"))
        dealt = dealt.union(large.select(*columns))
    return dealt


def _heavy_tasks(heavy: DataFrame, weight: Column, first_round: bool, task_weight: int) -> DataFrame:
    """Members of heavy groups dealt to tasks, a copy for each task that joins
    them.  ``first_round``: each block with the leading block of its own band and
    of the next.  Otherwise ``outside`` members' blocks with all blocks of the
    bands around."""
    bands = _bands(heavy, weight, task_weight).drop("c", "o", "copies")
    rows = heavy.join(bands, ["g", "band"]).withColumn("part", F.lit(0).cast("long"))
    h = F.xxhash64("v")
    block = F.pmod(h, F.col("k"))
    task = lambda *x: F.concat_ws("|", F.col("g"), *x)
    upto = lambda n, f: F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("long"), n - 1), f)).otherwise(
        F.array().cast("array<string>"))
    band = F.col("band")
    if first_round:
        own = F.array(task(band, block, band))
        ahead = F.when(F.col("k_after") > 0, F.array(task(band, block, band + 1))).otherwise(F.array().cast("array<string>"))
        leads = F.when(block == 0, F.concat(upto(F.col("k"), lambda j: task(band, j, band)),
                                            upto(F.col("k_before"), lambda j: task(band - 1, j, band))))
        tasks = F.array_distinct(F.concat(own, ahead, F.coalesce(leads, F.array().cast("array<string>"))))
        return rows.withColumn("task", F.explode(tasks))
    # task: outside block (band b, s) against block (band c, j), c in b-1..b+1
    mine = F.pmod(h, F.col("s"))
    def both_sides(shift: int, k: str, s: str) -> list[Column]:
        as_outside = upto(F.col(k), lambda j: task(band, mine, band + shift, j))
        return [F.when(F.col("outside"), as_outside).otherwise(F.array().cast("array<string>")),
                upto(F.col(s), lambda i: task(band + shift, i, band, block))]

    pairs = (both_sides(-1, "k_before", "s_before") + both_sides(0, "k", "s") + both_sides(1, "k_after", "s_after"))
    return rows.withColumn("task", F.explode(F.array_distinct(F.concat(*pairs))))


def near_duplicates(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT,
                    chunk_bytes: int = 4 << 20, task_weight: int = TASK_WEIGHT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, component, text_hash)`` for each row of
    ``docs(doc_id, text)``; other columns are not read.  ``component``: a number
    that linked rows share, null for a row that surely has no link.

    A set holds the distinct shingles of ``width`` words (A-Z lower-cased) of the
    whole text, or the whole sequence of a shorter one.  Documents with
    ``100 * intersection >= percent * union`` link; ``component_id`` is the least
    id reachable.  A text that is null, empty or white space has no set and is its
    own component, as is any document without a link; a null ``doc_id`` without a
    link keeps a null component.  Rows with equal sets link, repeated rows among
    them.  Shingles and sets are told apart by 64-bit hashes."""
    sets = _stored(shingle_sets(docs, width, percent, chunk_bytes), "shingle-sets")
    classes = _stored(sets.where("keys is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("root"), F.first("n").alias("n"), F.first("keys").alias("keys"))
        .withColumnRenamed("set_id", "v"), "shingle-classes")

    held = classes.select("v", F.explode(_leading(percent)).alias("key"))
    leads = held.groupBy("key").agg(F.min("v").alias("lead"), F.count(F.lit(1)).alias("c")).where("c > 1")
    meet = held.join(leads, "key").where("v <> lead").select(F.col("v").alias("u"), F.col("lead").alias("v")).distinct()
    groups = components(meet).withColumnRenamed("component", "g")

    weight = F.size("keys") + MEMBER_WEIGHT
    members = classes.select("v", "n", "keys").join(groups, "v").withColumn("label", F.col("v"))
    weights = classes.select("v", weight.alias("w")).join(groups, "v").groupBy("g").agg(F.sum("w").alias("w"))
    weights = _stored(weights, "group-weights")
    light_total = weights.where(F.col("w") <= task_weight).agg(F.sum("w")).first()[0] or 0
    bins = max(1, math.ceil(2 * light_total / task_weight))
    light = members.join(weights.where(F.col("w") <= task_weight), "g").select(
        F.pmod(F.xxhash64("g"), F.lit(bins)).cast("string").alias("task"), F.col("g").alias("part"),
        "v", "label", "n", "keys")
    found = _join_tasks(light, percent)

    if weights.where(F.col("w") > task_weight).limit(1).count():
        heavy = members.join(weights.where(F.col("w") > task_weight), "g").drop("w").withColumn(
            "band", F.floor(F.log("n") / BAND)).withColumn("outside", F.lit(False))
        dealt = _heavy_tasks(heavy, weight, True, task_weight).select("task", "part", "v", "label", "n", "keys")
        first = _stored(_join_tasks(dealt, percent), "links")
        now = heavy.drop("label").join(components(first), "v", "left").withColumn(
            "label", F.coalesce("component", "v")).drop("component")
        second = _join_tasks(_second_round(_with_outside(now), weight, percent, task_weight), percent)
        found = found.union(first).union(second)

    joined = components(found)
    roots = classes.select("v", "root").join(joined, "v", "left").withColumn("c", F.coalesce("component", "v"))
    least_root = roots.groupBy("c").agg(F.min("root").alias("least"))
    answer = roots.join(least_root, "c").select(F.col("v").alias("set_id"), F.col("c").alias("component"), "least")
    return sets.select("doc_id", "text_hash", "n", "set_id").join(answer, "set_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"),
        "component", "text_hash")


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """``docs``, all columns, with one row of each component: that of the least
    ``doc_id`` (a null one last), then of the least hash of the text; of rows that
    repeat its id and text, one.  Documents without a link stay, those without
    words too."""
    return under_other_names(docs, ("doc_id", "text"), lambda d: _one_of_each(d, **how))


def _one_of_each(docs: DataFrame, **how) -> DataFrame:
    found = near_duplicates(docs.select("doc_id", "text"), **how).where("component is not null")
    rows = found.groupBy("component", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("text_hash").alias("c"))
    first = rows.groupBy("component").agg(F.min(order).alias("first"))
    keep = order == F.col("first")
    decided = _stored(rows.join(first, "component").where(~keep | (F.col("copies") > 1)).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), keep.alias("__keep")), "copies")
    side = F.broadcast(decided) if decided.count() <= BROADCAST_ROWS else decided
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    out = docs.join(side, same, "left")
    once = out.where("__keep is null")
    if decided.where("__keep").limit(1).count():
        once = once.unionByName(out.where("__keep").dropDuplicates(["doc_id", "text"]))
    out = once
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
