"""URL parts, rules, and trees that learn a lexical rule."""

import math
import random
import re

import pytest

from small import tuples
from termite.llm import url_filter as U


def brute(url):
    after = (url or "").partition("://")[2]
    host = re.match(r"[^/?#]*", after)[0]
    path = re.match(r"[^?#]*", after[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for h, p, verdict in U.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return host, path, best[0] if best else None, best[1] if best else None


URLS = ["https://a.Example.ORG/es/1", "http://example.org/en/12?x#y", "http://example.org/en/2", "http://notexample.org/es/",
        "http://org", "http://org/", "http://x.com/fr/", "http://x.com/de", "HTTP://X.COM/de/é?q", "http://É.com/fr/a://b/c", "no scheme",
        "", None, "://", "http://h?q=/x", "http://u@h:80/p#f/?"]


def test_parts_and_rules(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").selectExpr(
        "*", "'x' host", "'y' verdict", "1 label", "2 score", "3 f_length", "4 b", "5 c",
        "6 __suffix", "7 __label", "8 said", "9 suffix", "10 half", "11 row", "12 `all0`", "13 `of`", "14 labelled")
    got = {r.page_id: r for r in U.judge(df).collect()}
    for i, url in enumerate(URLS):
        host, path, rule, verdict = brute(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert (got[i].f_length, got[i].suffix, got[i].row, got[i].label, got[i].labelled) == (3, 9, 11, 1, 14)
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")


def test_trees_learn_and_agree(spark):
    rules = (("good.com", "/", "allow"), ("bad.com", "/", "block"))
    rows = [(i, f"http://good.com/news/{'abcdefgh'[i % 8]}") for i in range(300)]
    rows += [(1000 + i, f"http://bad.com/{i * 7919}{i}?a=1&b={i}&c=3") for i in range(300)]
    rows += [(2000 + i, f"http://other.net/{'story' if i % 2 else f'{i * 104729}?x={i}&y=2&z=3'}") for i in range(100)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = U.judge(df, rules)
    assert {r.verdict for r in got.where("page_id >= 2000 and page_id % 2 = 1").collect()} == {"allow"}
    assert {r.verdict for r in got.where("page_id >= 2000 and page_id % 2 = 0").collect()} == {"block"}
    assert tuples(U.judge(df.repartition(5), rules)) == tuples(got)


def test_few_labels_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "http://x.net/a"), (1, "http://x.net/a"), (2, None)], "page_id long, url string")
    assert [r.verdict for r in U.judge(df).collect()] == ["allow"] * 3
    one = df.union(spark.createDataFrame([(3, "http://x.com/de/")], df.schema))
    assert [r.verdict for r in U.judge(one).where("rule is null").collect()] == ["block"] * 3
    assert U.judge(df.limit(0)).count() == 0
    assert U.judge(spark.createDataFrame([(1, "http://x.net/" + "a" * 100_000)], df.schema)).count() == 1


def plain_features(url, label, other_half):
    host, path, _, _ = brute(url)
    n = max(1, len(url))
    entropy = -sum(url.count(c) / n * math.log2(url.count(c) / n) for c in set(url))
    blocked, labelled, prior, total = other_half(url, host.split(".")[-1], label)
    return [len(url), len(path), path.count("/"), len(re.findall("[0-9]", url)) / n, round(entropy, 9),
            url.count("?") + url.count("&"), (blocked + 10 * prior) / (labelled + 10), math.log1p(total)]


def plain_boosting(x, label):
    """Trees as nested tuples, grown node by node over lists of rows."""
    n, blocked = len(x), sum(label)
    cuts = [sorted({sorted(r[f] for r in x)[math.ceil(n * i / U.BINS) - 1] for i in range(1, U.BINS)}) for f in range(8)]
    whole = lambda v: math.floor(abs(v) * U.SCALE + 0.5) * (1 if v >= 0 else -1)

    def grow(rows, grad, hess, depth):
        g_all, h_all = sum(grad[i] for i in rows), sum(hess[i] for i in rows)
        value = U.RATE * g_all / (h_all + U.SCALE)
        best, split = 1e-9, None
        for f in range(8) if depth else ():
            for cut in cuts[f]:
                left = [i for i in rows if x[i][f] <= cut]
                if len(left) in (0, len(rows)):
                    continue
                g, h = sum(grad[i] for i in left), sum(hess[i] for i in left)
                gain = g * g / (h + U.SCALE) + (g_all - g) ** 2 / (h_all - h + U.SCALE) - g_all ** 2 / (h_all + U.SCALE)
                if gain > best:
                    best, split = gain, (f, cut, left)
        if split is None:
            return value
        f, cut, left = split
        right = [i for i in rows if x[i][f] > cut]
        return f, cut, grow(left, grad, hess, depth - 1), grow(right, grad, hess, depth - 1)

    def leaf(tree, row):
        while isinstance(tree, tuple):
            tree = tree[3 if row[tree[0]] > tree[1] else 2]
        return tree

    prior = math.log((blocked + 0.5) / (n - blocked + 0.5))
    trees, margin = [], [prior] * n
    for _ in range(U.TREES):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        tree = grow(range(n), [whole(y - q) for y, q in zip(label, p)], [whole(q * (1 - q)) for q in p], U.DEPTH)
        trees.append(tree)
        margin = [m + leaf(tree, r) for m, r in zip(margin, x)]
    return lambda row: prior + sum(leaf(t, row) for t in trees)


@pytest.mark.parametrize("limit", [U.BROADCAST_BYTES, 0])
def test_scores_and_verdicts_against_plain_boosting(spark, monkeypatch, limit):
    monkeypatch.setattr(U, "BROADCAST_BYTES", limit)
    rng = random.Random(11)
    urls = [f"http://{rng.choice(['a.example.org', 'b.org', 'x.com', 'y.z.com', 'n.net', 'q.io'])}/{rng.choice(['es', 'en', 'fr', 'de'])}/"
            f"{'/'.join(rng.choice(['news', 'x', '12', '7' * rng.randrange(1, 9)]) for _ in range(rng.randrange(4)))}"
            f"{'?a=1&b=' + str(rng.randrange(99)) if rng.random() < 0.4 else ''}" for _ in range(160)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    half = {r.url: r.half for r in df.selectExpr("url", "pmod(xxhash64(url), 2) half").collect()}
    said = [{"block": 1, "allow": 0}.get(brute(u)[3]) for u in urls]
    known = [(u, brute(u)[0].split(".")[-1], y) for u, y in zip(urls, said) if y is not None]
    prior = (sum(y for *_, y in known) + 0.5) / (len(known) + 1)

    def other_half(url, suffix, label):
        some = [y for u, s, y in known if s == suffix and (label is None or half[u] != half[url])]
        return sum(some), len(some), prior, sum(s == suffix for _, s, _ in known)

    x = [plain_features(u, y, other_half) for u, y in zip(urls, said)]
    predict = plain_boosting([r for r, y in zip(x, said) if y is not None], [y for y in said if y is not None])
    for r in U.judge(df).collect():
        want = predict(x[r.page_id])
        assert abs(r.score - want) < 1e-6
        assert r.verdict == (brute(r.url)[3] or ("block" if want > 0 else "allow"))
