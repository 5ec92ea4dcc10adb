"""URL filtering by rules and by gradient-boosted trees on lexical features
(DataFrame functions only).

URLs that a rule decides are the labelled ones.  Trees are grown level by level:
one aggregate sums gradients by node, feature and bin (at most ``nodes * features
* bins`` rows reach the driver), the best split of each node becomes part of a
SQL expression, and scoring is that expression over all URLs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termite.llm.decontaminate import LOWER, UPPER
from termite.session import cut_lineage

# The longest fitting rule decides: (host, path prefix, verdict).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
MAX_TRAINING_URLS = 20_000
TREES, DEPTH, BINS, RATE = 12, 3, 16, 0.3
SCALE = 1 << 20  # gradients are summed as integers, so that reruns agree
BROADCAST_BYTES = 32 << 20  # suffix statistics that are sent to all tasks; more are joined by a shuffle
FEATURES = ("f_length", "f_path", "f_depth", "f_digits", "f_entropy", "f_params", "f_suffix_rate", "f_suffix_count")
PARTS = ("host", "path", "rule", "verdict", "score")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; path: from there up to ``?``, ``#`` or the end.  Both empty for a
    null URL or one without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def _rule(rules: tuple, value: int) -> Column:
    """The longest rule that fits ``host`` and ``path``: its name (value -1) or
    another of its parts; null if none fits."""
    cases = []
    for r in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((F.col("host") == r[0]) | F.endswith("host", F.lit("." + r[0]))) & F.startswith("path", F.lit(r[1]))
        cases.append(F.when(fits, F.lit(r[0] + r[1] if value < 0 else r[value])))
    return F.coalesce(*cases, F.lit(None).cast("string"))


def _features() -> list[Column]:
    """Lexical features of ``url`` and ``path``; those of the suffix are joined."""
    url = F.coalesce(F.col("url"), F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))
    share = lambda c: (F.length(url) - F.length(F.replace(url, c))) / n
    entropy = F.aggregate(F.array_distinct(F.array_remove(F.split(url, ""), "")), F.lit(0.0),
                          lambda s, c: s - share(c) * F.log2(share(c)))
    slashes = F.length("path") - F.length(F.translate("path", "/", ""))
    return [F.length(url).cast("double").alias("f_length"), F.length("path").cast("double").alias("f_path"),
            slashes.cast("double").alias("f_depth"), (F.length(F.regexp_replace(url, "[^0-9]", "")) / n).alias("f_digits"),
            F.round(entropy, 9).alias("f_entropy"),
            (F.length(url) - F.length(F.translate(url, "?&", ""))).cast("double").alias("f_params")]


def _with_suffix_features(urls: DataFrame) -> DataFrame:
    """``urls`` with block rate and count of the labelled URLs of their ``suffix``.

    The labelled ones are halved by a hash; a labelled URL gets the rate of the
    other half, so that its own label is not in its features."""
    labelled = urls.where("label is not null")
    by_suffix = cut_lineage(labelled.groupBy(F.col("suffix").alias("of")).agg(
        *[F.sum(F.when(F.col("half") == i, x).otherwise(0)).alias(f"{name}{i}")
          for i in (0, 1) for name, x in (("blocked", F.col("label")), ("all", F.lit(1)))]))
    both = F.col("all0") + F.col("all1")
    total, all_blocked, size = by_suffix.agg(
        F.coalesce(F.sum(both), F.lit(0)), F.coalesce(F.sum(F.col("blocked0") + F.col("blocked1")), F.lit(0)),
        F.coalesce(F.sum(F.octet_length("of") + 60), F.lit(0))).first()
    by_suffix = F.broadcast(by_suffix) if size <= BROADCAST_BYTES else by_suffix

    def of_the_others(name: str) -> Column:
        counts = [F.coalesce(F.col(f"{name}{i}"), F.lit(0)) for i in (0, 1)]
        return F.when(F.col("label").isNull(), counts[0] + counts[1]).when(F.col("half") == 0, counts[1]).otherwise(counts[0])

    rate = (of_the_others("blocked") + F.lit(10 * (all_blocked + 0.5) / (total + 1))) / (of_the_others("all") + 10)
    return urls.join(by_suffix, F.col("suffix") == F.col("of"), "left").select(
        *urls.columns, rate.alias("f_suffix_rate"), F.log1p(F.coalesce(both, F.lit(0)).cast("double")).alias("f_suffix_count"),
        F.lit(total).alias("labelled"))


def _tree(splits: dict[int, str], leaf, node: int = 0) -> str:
    if node not in splits:
        return leaf(node)
    return f"IF({splits[node]}, {_tree(splits, leaf, 2 * node + 2)}, {_tree(splits, leaf, 2 * node + 1)})"


def _best_split(by: dict[int, list], cuts: dict[str, list]) -> tuple | None:
    """Condition and the two sides' ``(g, h)`` of the largest gain, from ``(bin, g,
    h)`` by feature."""
    best, split = 1e-9, None
    for feature, bins in sorted(by.items()):
        g_all, h_all = (sum(x[i] for x in bins) for i in (1, 2))
        g = h = 0
        for bin_, dg, dh in sorted(bins)[:-1]:
            g, h = g + dg, h + dh
            gain = g * g / (h + SCALE) + (g_all - g) ** 2 / (h_all - h + SCALE) - g_all ** 2 / (h_all + SCALE)
            if gain > best:
                best, split = gain, (f"{FEATURES[feature]} > {cuts[FEATURES[feature]][bin_]!r}D", (g, h), (g_all - g, h_all - h))
    return split


def train(rows: DataFrame) -> str:
    """SQL for the log-odds of a block, from labelled ``rows(label, *FEATURES)``.

    Bins lie between approximate quantiles.  A leaf's value is a Newton step on the
    log loss.  Without labels the score is 0; with one kind only, its prior."""
    rows = cut_lineage(rows)
    n, blocked = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    margin = f"{math.log((blocked + 0.5) / (n - blocked + 0.5)):.12f}D"
    if blocked in (0, n):
        return margin
    quantiles = rows.agg(*[F.percentile_approx(f, [i / BINS for i in range(1, BINS)], 10_000).alias(f)
                           for f in FEATURES]).first()
    cuts = {f: sorted(set(quantiles[f])) for f in FEATURES}
    kinds = F.array(*[F.struct(F.lit(i).alias("feature"), sum(
        (F.when(F.col(f) > c, 1).otherwise(0) for c in cuts[f]), F.lit(0)).alias("bin")) for i, f in enumerate(FEATURES)])
    binned = cut_lineage(rows.withColumn("kinds", kinds))
    for _ in range(TREES):
        splits: dict[int, str] = {}  # a node's condition; its children are 2 n + 1 (false) and 2 n + 2
        p = F.expr(f"1D / (1D + exp(-({margin})))")
        graded = binned.withColumn("g", F.round((F.col("label") - p) * SCALE).cast("long")).withColumn(
            "h", F.round(p * (1 - p) * SCALE).cast("long"))
        value: dict[int, float] = {}
        for _ in range(DEPTH):
            sums = graded.select(F.expr(_tree(splits, str)).alias("node"), "g", "h", F.explode("kinds").alias("k")).groupBy(
                "node", "k.feature", "k.bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
            nodes: dict[int, dict] = {}
            for r in sums:
                nodes.setdefault(r.node, {}).setdefault(r.feature, []).append((r.bin, r.g, r.h))
            for node, by in nodes.items():
                value[node] = RATE * sum(x[1] for x in by[0]) / (sum(x[2] for x in by[0]) + SCALE)
                if split := _best_split(by, cuts):
                    splits[node] = split[0]
                    value[2 * node + 1], value[2 * node + 2] = (RATE * g / (h + SCALE) for g, h in split[1:])
        margin += " + " + _tree(splits, lambda n: f"{value[n]:.12f}D")
    return margin


def judge(pages: DataFrame, rules: tuple = RULES, max_training_urls: int = MAX_TRAINING_URLS) -> DataFrame:
    """``pages``, any columns with a ``url``, with ``host``, ``path``, ``rule``
    (``host`` + ``path`` of the one that decides, else null), ``verdict`` (allow or
    block: the rule's, else the trees') and ``score`` (log-odds of block), which
    replace columns of these names.

    Suffix statistics (block rate and count by the host's last label) cover all
    URLs that rules decide; the trees are fitted on about ``max_training_urls`` of
    them, picked by a hash.  A null or odd URL has an empty host and path, no rule,
    and is judged by its features.  Without labelled URLs all others are allowed.
    Repeated rows get equal results; an empty table gives an empty one.  Columns of
    other names are kept as they are."""
    pages = pages.drop(*PARTS)
    host, path = host_and_path(F.col("url"))
    parts = pages.select(F.struct(*pages.columns).alias("row"), "url", host.alias("host"), path.alias("path"))
    said = _rule(rules, 2)
    urls = parts.select(
        "*", _rule(rules, -1).alias("rule"), said.alias("said"), F.when(said == "block", 1).when(said == "allow", 0).alias("label"),
        F.substring_index("host", ".", -1).alias("suffix"), F.pmod(F.xxhash64("url"), F.lit(2)).alias("half"), *_features())
    ready = _with_suffix_features(urls)
    part = F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < F.lit((1 << 30) * max_training_urls) / F.greatest("labelled", F.lit(1))
    score = train(ready.where(F.col("label").isNotNull() & part).select("label", *FEATURES))
    return ready.withColumn("score", F.expr(score)).select(
        "row.*", "host", "path", "rule", "score",
        F.coalesce("said", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"))
