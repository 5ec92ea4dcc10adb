"""Boolean retrieval.

A Boolean query becomes rows of a small expression tree: leaves are operands,
inner nodes ``AND`` (some children may be excluded, which is ``AND_NOT``) or
``OR``, each with any number of children, so the rows grow with the length of the
query only.  Evaluation decides what one document's terms decide in a row of that
document, led by the rarest term, then folds one level of all queries' trees at a
time by a join with the tree and one aggregation.

Query language (as in the original search form): operands and the operators
``AND``, ``OR``, ``AND_NOT`` (any case) and parentheses.  The three operators have
equal precedence and associate to the left; operands left over without an
operator are OR-ed.  Other punctuation is no syntax: operands are normalised like
documents (ledger D16, D17).  Operands that the corpus lacks are replaced by the
nearest corpus term if a vocabulary is given.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termite.functions.text import normalise
from termite.operators.conflation import Conflation, term_arrays
from termite.plans.sizing import broadcast_if_small
from termite.session import stored

OPERATORS = ("AND", "OR", "AND_NOT")


class Node:
    """``kind`` TERM, AND or OR; ``parts``: children with their exclusion."""

    def __init__(self, kind: str, term: str = ""):
        self.kind, self.term, self.height = kind, term, 0
        self.parts: list[tuple[Node, bool]] = []

    def add(self, child: "Node", excluded: bool = False) -> "Node":
        self.parts.append((child, excluded))
        self.height = max(self.height, child.height + 1)
        return self


def _combine(operator: str, left: Node, right: Node) -> Node:
    """Left-associative, so a node of the same kind on the left takes one more
    child."""
    kind = "OR" if operator == "OR" else "AND"
    node = left if left.kind == kind else Node(kind).add(left)
    return node.add(right, operator == "AND_NOT")


def read_query(query: str) -> Node:
    """The query's tree; ``ValueError`` for a malformed one."""
    frames: list[tuple[list[Node], list[str]]] = [([], [])]  # operands and pending operator by open parenthesis

    def settle(operands: list[Node], pending: list[str]) -> None:
        if pending:
            if len(operands) < 2:
                raise ValueError(f"operator {pending[0]} lacks an operand")
            right, left = operands.pop(), operands.pop()
            operands.append(_combine(pending.pop(), left, right))

    for token in re.findall(r"[()]|[^\s()]+", query):
        operands, pending = frames[-1]
        if token == "(":
            frames.append(([], []))
        elif token == ")":
            if len(frames) == 1:
                raise ValueError("unbalanced )")
            settle(operands, pending)
            frames.pop()
            frames[-1][0].extend(operands)
        elif token.upper() in OPERATORS:
            settle(operands, pending)
            pending.append(token.upper())
        else:
            operands.append(Node("TERM", token))
    if len(frames) > 1:
        raise ValueError("unbalanced (")
    operands, pending = frames[0]
    settle(operands, pending)
    if not operands:
        raise ValueError("no operand")
    root = operands[0]
    for other in operands[1:]:
        root = _combine("OR", root, other)
    return root


NODES = T.StructType([
    T.StructField("query_id", T.LongType()), T.StructField("node", T.IntegerType()), T.StructField("parent", T.IntegerType()),
    T.StructField("excluded", T.BooleanType()), T.StructField("kind", T.StringType()), T.StructField("needed", T.IntegerType()),
    T.StructField("height", T.IntegerType()), T.StructField("parent_height", T.IntegerType()),
    T.StructField("parent_kind", T.StringType()), T.StructField("parent_needed", T.IntegerType()),
    T.StructField("raw_term", T.StringType()), T.StructField("status", T.StringType())])


def _needed(n: Node) -> int:
    return sum(not excluded for _, excluded in n.parts)


def tree_rows(query: str | None) -> list[tuple]:
    """Rows of ``NODES`` without the query id; a query without a tree is one row
    with its status."""
    try:
        root = read_query(query or "")
    except ValueError as why:
        return [(-1, -1, False, None, 0, -1, -1, None, 0, None, str(why))]
    rows, todo, number = [], [(root, -1, None, False)], 0
    while todo:
        n, parent, above, excluded = todo.pop()
        rows.append((number, parent, excluded, n.kind, _needed(n), n.height, above.height if above else -1,
                     above.kind if above else None, _needed(above) if above else 0, n.term or None, "ok"))
        todo += [(child, number, n, out) for child, out in reversed(n.parts)]
        number += 1
    return rows


def _tree_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(int(qid), *row) for qid, text in zip(pdf["query_id"], pdf["query"]) for row in tree_rows(text)]
        yield pd.DataFrame(rows, columns=NODES.names)


def parse_queries(queries: DataFrame) -> DataFrame:
    """``(query_id, query)`` -> rows of ``NODES``.  Every query has one at least: a
    malformed one has no node and a ``status`` other than ``ok``."""
    return queries.select("query_id", "query").mapInPandas(_tree_batches, NODES)


def rejected_queries(nodes: DataFrame) -> DataFrame:
    """``(query_id, status)`` of the malformed queries."""
    return nodes.where("status <> 'ok'").select("query_id", "status")


def operand_terms(nodes: DataFrame, stemmer: str | None | Conflation = "s", vocab: DataFrame | None = None) -> DataFrame:
    """``(query_id, node, pos, term, corrected)`` of the leaves.  An operand that
    normalises to several terms needs all of them; one that normalises to none (a
    stop word) keeps its lower-case form."""
    from termite.operators.spelling import correct_query_terms

    leaves = nodes.where("kind = 'TERM'").select("query_id", "node", "raw_term")
    if isinstance(stemmer, Conflation) or stemmer == "porter":
        distinct = leaves.select("raw_term").distinct().withColumn("text", F.col("raw_term"))
        leaves = leaves.join(term_arrays(distinct, "raw_term", "text", stemmer), "raw_term")
    else:
        leaves = leaves.withColumn("terms", normalise(F.col("raw_term"), stemmer))
    leaves = leaves.select("query_id", "node", F.posexplode(
        F.when(F.size("terms") > 0, F.col("terms")).otherwise(F.array(F.lower("raw_term")))).alias("pos", "term"))
    if vocab is None:
        return leaves.withColumn("corrected", F.col("term"))
    distinct = leaves.select(F.lit(0).alias("query_id"), F.lit(0).alias("pos"), "term").distinct()
    fixes = correct_query_terms(distinct, vocab).select("term", "corrected")
    return leaves.join(fixes, "term", "left").select(
        "query_id", "node", "pos", "term", F.coalesce("corrected", "term").alias("corrected"))


def suggestions(terms: DataFrame) -> DataFrame:
    """C5 for Boolean queries: the operands in query order, corrected; only for
    queries with a correction."""
    per_query = terms.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("node", "pos", "corrected"))).alias("t"),
        F.max(F.col("term") != F.col("corrected")).alias("changed"))
    return per_query.where("changed").select(
        "query_id", F.array_join(F.transform("t", lambda x: x["corrected"]), " ").alias("suggestion"))


def _units(tree: DataFrame, terms: DataFrame, frequency: DataFrame) -> DataFrame:
    """``(query_id, node, lead, needed, barred)``: the parts of the trees that one
    document's terms decide: AND nodes over operands only, and operands elsewhere.
    ``needed``: the terms that a document must hold, ``lead`` the rarest of them;
    ``barred``: sets of terms of which it must not hold one whole."""
    leaves = terms.groupBy("query_id", "node").agg(F.collect_set("corrected").alias("terms"))
    leaves = tree.where("kind = 'TERM'").select("query_id", "node", "parent", "excluded", "parent_kind").join(leaves, ["query_id", "node"])
    inner = tree.where("parent >= 0").groupBy("query_id", "parent").agg(F.max(F.col("kind") != "TERM").alias("mixed"))
    flat = inner.where("not mixed").select("query_id", "parent")
    flat = tree.where("kind = 'AND'").select("query_id", F.col("node").alias("parent")).join(flat, ["query_id", "parent"])
    whole = leaves.join(flat.withColumn("flat", F.lit(True)), ["query_id", "parent"], "left")
    ands = whole.where("flat").groupBy("query_id", F.col("parent").alias("node")).agg(
        F.array_distinct(F.flatten(F.collect_list(F.when(~F.col("excluded"), F.col("terms"))))).alias("needed"),
        F.collect_list(F.when(F.col("excluded"), F.col("terms"))).alias("barred"))
    single = whole.where("flat is null").select("query_id", "node", F.col("terms").alias("needed"),
                                                F.array().cast("array<array<string>>").alias("barred"))
    units = stored(ands.unionByName(single), "query-units")
    rarest = units.select("query_id", "node", F.explode("needed").alias("term")).join(frequency, "term").groupBy("query_id", "node").agg(
        F.min(F.struct("df", "term")).alias("r"), F.count(F.lit(1)).alias("known"))
    # An operand that the corpus lacks answers nothing.
    return units.join(rarest, ["query_id", "node"]).where(F.col("known") == F.size("needed")).select(
        "query_id", "node", F.col("r.term").alias("lead"), "needed", "barred")


def _met_units(post: DataFrame, units: DataFrame) -> DataFrame:
    """``units`` of several terms with the ``doc_id`` that each of them fits."""
    units = stored(units, "several-terms")
    leads = units.select(F.col("lead").alias("term")).distinct().withColumn("leads", F.lit(True))
    words = units.select(F.explode(F.concat("needed", F.flatten("barred"))).alias("term")).distinct()
    words = broadcast_if_small(words.join(leads, "term", "left"))
    held = post.select("term", "doc_id").join(words, "term").groupBy("doc_id").agg(
        F.collect_set("term").alias("held"), F.collect_set(F.when(F.col("leads"), F.col("term"))).alias("leads"))
    met = held.select("doc_id", "held", F.explode("leads").alias("lead")).join(broadcast_if_small(units), "lead")
    return met.where((F.size(F.array_except("needed", "held")) == 0) & ~F.exists(
        "barred", lambda x: F.size(F.array_except(x, "held")) == 0)).drop("held", "needed", "barred", "lead", "alone")


def evaluate(post: DataFrame, nodes: DataFrame, terms: DataFrame, frequency: DataFrame | None = None) -> DataFrame:
    """``(query_id, doc_id)`` (distinct, unordered) of parsed queries and their
    operand terms; ``frequency(term, df)`` is counted from the postings if None.

    A unit (see :func:`_units`) of one term is answered by that term's postings.  For
    the others the wanted terms of each document that holds a unit's rarest term make
    one row, in which the unit is decided.  The levels above are folded from there up;
    each reads only the units and nodes right below it.  With postings bucketed by
    document and the queries' tables small enough to be broadcast, a level needs an
    exchange only if nodes of one height stand below several heights.  Only the heights
    that occur come to the driver."""
    tree = stored(nodes.where("status = 'ok'"), "query-trees")
    wanted = broadcast_if_small(terms.select(F.col("corrected").alias("term")).distinct())
    if frequency is None:
        frequency = post.select("term", "doc_id").join(wanted, "term").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    above = ["parent", "excluded", "parent_height", "parent_kind", "parent_needed"]
    up = broadcast_if_small(tree.select("query_id", "node", *above))
    alone = (F.size("needed") == 1) & (F.size("barred") == 0)
    units = stored(_units(tree, terms, frequency.select("term", "df")).join(up, ["query_id", "node"]).withColumn("alone", alone), "placed-units")
    below: dict[int, set] = {}
    for r in units.select("parent_height", "alone", "parent_kind").distinct().collect():
        below.setdefault(r["parent_height"], set()).add("any" if r["alone"] and r["parent_kind"] == "OR" else "one" if r["alone"] else "several")
    above_of: dict[int, set] = {}
    for r in tree.where("height > 0").select("height", "parent_height").distinct().collect():
        above_of.setdefault(r["height"], set()).add(r["parent_height"])
    columns = ["query_id", "node", "doc_id", *above]
    several = _met_units(post, units.where("not alone")) if any("several" in kinds for kinds in below.values()) else None
    if several is not None and sum("several" in kinds for kinds in below.values()) > 1:
        several = stored(several, "met-units")
    folds: dict[int, DataFrame] = {}

    def rows_below(height: int) -> list[DataFrame]:
        """What stands right below the nodes of ``height``, by kind."""
        kinds, out = below.get(height, set()), []
        of = lambda x: units.where((F.col("parent_height") == height) & F.col("alone") & ((F.col("parent_kind") == "OR") if x else
                                   ((F.col("parent_kind") != "OR") | F.col("parent_kind").isNull()))).withColumnRenamed("lead", "term")
        if "any" in kinds:  # one of an OR's terms is as good as the other
            side = broadcast_if_small(of(True).select("term", "query_id", F.col("parent").alias("node"), *above).distinct())
            out.append(post.select("term", "doc_id").join(side, "term").select(columns))
        if "one" in kinds:
            side = broadcast_if_small(of(False).select("term", "query_id", "node", *above))
            out.append(post.select("term", "doc_id").join(side, "term").select(columns).distinct())
        if "several" in kinds:
            out.append(several.where(F.col("parent_height") == height).select(columns))
        out += [kept.where(F.col("parent_height") == height).select(columns) for h, kept in folds.items() if height in above_of[h]]
        return out

    def joined(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for more in parts[1:]:
            out = out.unionByName(more)
        return out

    for height in sorted(above_of):
        parts = rows_below(height)
        if not parts:
            continue
        folded = joined(parts).groupBy("query_id", "parent", "doc_id", "parent_kind", "parent_needed").agg(
            F.count_if(~F.col("excluded")).alias("held"), F.max("excluded").alias("out"))
        kept = folded.where(F.when(F.col("parent_kind") == "OR", F.col("held") > 0).otherwise(
            (F.col("held") == F.col("parent_needed")) & ~F.col("out"))).select(
            "query_id", F.col("parent").alias("node"), "doc_id").join(up, ["query_id", "node"])
        folds[height] = stored(kept, "folded-level") if len(above_of[height]) > 1 else kept
    found = rows_below(-1)
    if not found:
        kinds = {f.name: f.dataType for f in (*post.schema.fields, *tree.schema.fields)}
        return post.select(F.lit(None).cast(kinds["query_id"]).alias("query_id"), "doc_id").limit(0)
    return joined(found).select("query_id", "doc_id")


def retrieve(post: DataFrame, queries: DataFrame, stemmer: str | None | Conflation = "s", vocab: DataFrame | None = None) -> DataFrame:
    """B6 for ``(query_id, query)``; with ``vocab(term, first_doc, first_pos)``
    operands that the corpus lacks are corrected, and its ``df`` is used if it has
    that column."""
    nodes = stored(parse_queries(queries), "query-nodes")
    frequency = vocab if vocab is not None and "df" in vocab.columns else None
    return evaluate(post, nodes, stored(operand_terms(nodes, stemmer, vocab), "query-operands"), frequency)


def feedback(queries: DataFrame, vocab: DataFrame, stemmer: str | None | Conflation = "s") -> DataFrame:
    """``(query_id, status, suggestion)`` of every query: "ok" or why it is malformed,
    and the corrected operands where one was corrected ("did you mean")."""
    nodes = stored(parse_queries(queries), "query-nodes")
    status = nodes.groupBy("query_id").agg(F.first("status").alias("status"))
    meant = suggestions(operand_terms(nodes, stemmer, vocab))
    return status.join(meant, "query_id", "left").select("query_id", "status", "suggestion")


def first_documents(hits: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, doc_id)``, the first k documents of each query by id; k
    rows a query leave each partition of the hits."""
    w = Window.partitionBy("query_id").orderBy("doc_id")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "doc_id")


# --- set operators on (query_id, doc_id) results --------------------------------

def bool_and(left: DataFrame, right: DataFrame) -> DataFrame:
    """B1: documents in both (hash join, no per-row Python)."""
    return left.select("query_id", "doc_id").intersect(right.select("query_id", "doc_id"))


def bool_or(left: DataFrame, right: DataFrame) -> DataFrame:
    """B2: documents in either."""
    return left.select("query_id", "doc_id").union(right.select("query_id", "doc_id")).distinct()


def bool_and_not(left: DataFrame, right: DataFrame) -> DataFrame:
    """Documents in ``left`` and not in ``right`` (whole corpus; ledger D1)."""
    return left.select("query_id", "doc_id").distinct().join(
        right.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_anti")
