"""Main text of pages: what a page does not share with its nearest neighbour.

Pages are sorted by host and URL path; neighbours with the same texts are copies
and count as one page, however many.  A page is paired with the neighbour on its
own host whose path has the longer common start.  The lines of both are aligned
by longest common subsequence and the shared ones are deleted.

Sharing alone neither spares an article that is on two pages nor finds a menu
that the neighbour lacks, so the page's own elements go first: lines in menus,
headers, footers, sidebars, notices, adverts, forms and comments are deleted, the
lines of a declared article are kept, and the alignment decides on all others,
whether the page declares an article or not.

Sorting is by ranges, found on the URLs alone: a host with a third of all pages
spreads over many ranges.  A first pass finds the copies at the ranges' borders;
the nearest page that differs is sent to each range that they reach into, so that
every page meets its neighbours."""

from __future__ import annotations

import bisect
import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termite.llm.html_lines import Line, lines, shared
from termite.llm.url_filter import host_and_path

PAGES_A_RANGE = 2000
NO_ID = -(1 << 63)
KEY = ("host", "path", "id", "digest")


def _borders(keys: DataFrame, ranges: int) -> list[tuple]:
    """First key of each range of pages in order; at most ``ranges``."""
    key = F.struct("host", "path", "id")
    rows = keys.repartitionByRange(ranges, "host", "path", "id").groupBy(F.spark_partition_id()).agg(
        F.min(key).alias("a")).collect()
    return sorted(tuple(r.a) for r in rows)


def _common_start(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def main_lines(own: list[Line], other: list[Line] | None) -> list[str]:
    """The page's main lines, from its lines and those of its neighbour."""
    same = shared([x.text for x in own], [x.text for x in other]) if other is not None else [False] * len(own)
    return [x.text for x, s in zip(own, same) if not x.aside and (x.main or not s)]


def _read(page: str | None) -> tuple[bytes, bytes]:
    """A page's lines, packed, and the digest of their texts."""
    found = lines(page or "")
    return (zlib.compress(json.dumps(found, ensure_ascii=False).encode(), 1),
            hashlib.blake2b("\n".join(x.text for x in found).encode(), digest_size=16).digest())


def _runs(keys: list[tuple]) -> list[list[int]]:
    """Positions of sorted ``keys`` (host, path, id, digest), in runs of pages of
    one host with the same texts; a page without a host is a run of its own."""
    runs: list[list[int]] = []
    for i, key in enumerate(keys):
        if runs and key[0] and (key[0], key[3]) == (keys[i - 1][0], keys[i - 1][3]):
            runs[-1].append(i)
        else:
            runs.append([i])
    return runs


def _edges(table: pa.Table) -> pa.Table:
    """The first two and the last two runs of a range."""
    keys = sorted(zip(*(table.column(n).to_pylist() for n in KEY)))
    runs = _runs(keys)
    some = runs if len(runs) <= 4 else runs[:2] + runs[-2:]
    first, last = [keys[r[0]] for r in some], [keys[r[-1]] for r in some]
    return pa.table({
        "range": pa.array([table.column("range")[0].as_py()] * len(some), pa.int32()),
        "place": pa.array(range(len(some)), pa.int32()),
        "gap": pa.array([len(runs) > 4 and i == 2 for i in range(len(some))], pa.bool_()),
        "host": pa.array([k[0] for k in first], pa.string()),
        "first_path": pa.array([k[1] for k in first], pa.string()), "first_id": pa.array([k[2] for k in first], pa.int64()),
        "last_path": pa.array([k[1] for k in last], pa.string()), "last_id": pa.array([k[2] for k in last], pa.int64()),
        "digest": pa.array([k[3] for k in first], pa.binary())})


def _over_borders(edges: list) -> tuple[dict[tuple, set[int]], dict[int, str], dict[int, str]]:
    """Keys of the pages that other ranges need as neighbours, with those ranges;
    and by range the path where the run at its begin starts, if that is before it,
    and where the run at its end stops, if that is after it."""
    runs: list[dict] = []
    for e in sorted(edges, key=lambda e: (e.range, e.place)):
        first, last = ((e.host, p, i, bytes(e.digest)) for p, i in ((e.first_path, e.first_id), (e.last_path, e.last_id)))
        if runs and not e.gap and e.host and (runs[-1]["last"][0], runs[-1]["last"][3]) == (e.host, last[3]):
            runs[-1]["last"] = last
            runs[-1]["ranges"].append(e.range)
        else:
            runs.append({"first": first, "last": last, "ranges": [e.range], "gap": e.gap})
    send: dict[tuple, set[int]] = {}
    begins, ends = {}, {}
    for a, b in zip(runs, runs[1:]):
        if a["last"][0] and a["last"][0] == b["first"][0] and not b["gap"]:
            send.setdefault(a["last"], set()).update(k for k in b["ranges"] if k != a["ranges"][-1])
            send.setdefault(b["first"], set()).update(k for k in a["ranges"] if k != b["ranges"][0])
    for r in runs:
        begins.update((k, r["first"][1]) for k in r["ranges"][1:])
        ends.update((k, r["last"][1]) for k in r["ranges"][:-1])
    return {k: v for k, v in send.items() if v}, begins, ends


def extract(pages: DataFrame, pages_a_range: int = PAGES_A_RANGE) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for each row of ``pages(page_id, url,
    html)``; other columns are not read.

    A null or empty page has an empty text.  A null URL, or one without ``://``,
    has no host and such a page no neighbour.  Of equal URLs the larger
    ``page_id`` comes later, a null one first; rows that repeat in full are copies
    of each other.  An empty table gives an empty result."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", "html", host.alias("host"), path.alias("path"),
                        F.coalesce(F.col("page_id").cast("long"), F.lit(NO_ID)).alias("id"))
    ranges = max(16, -(-pages.count() // pages_a_range))
    firsts = _borders(rows.select("host", "path", "id"), ranges)
    kind = dict(pages.dtypes)["page_id"]
    columns = f"range int, own boolean, page_id {kind}, url string, host string, path string, id long, digest binary, lines binary"

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            keys = zip(*(batch.column(n).to_pylist() for n in ("host", "path", "id")))
            yield pa.RecordBatch.from_arrays(
                [pa.array([bisect.bisect_right(firsts, k) - 1 for k in keys], pa.int32()),
                 *[batch.column(n) for n in ("host", "path", "id")],
                 pa.array([_read(x)[1] for x in batch.column("html").to_pylist()], pa.binary())], names=["range", *KEY])

    edges = rows.mapInArrow(place, "range int, host string, path string, id long, digest binary").groupBy(
        "range").applyInArrow(_edges, "range int, place int, gap boolean, host string, first_path string, first_id long, "
                                      "last_path string, last_id long, digest binary").collect()
    send, begins, ends = _over_borders(edges)

    def parse(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for begin in range(0, batch.num_rows, 256):
                some = batch.slice(begin, 256)
                keys = list(zip(*(some.column(n).to_pylist() for n in ("host", "path", "id"))))
                packed, digests = zip(*map(_read, some.column("html").to_pylist()))
                at, place, own = [], [], []
                for i, key in enumerate(keys):
                    k = bisect.bisect_right(firsts, key) - 1
                    to = [k, *send.get((*key, digests[i]), ())]
                    at += [i] * len(to)
                    place += to
                    own += [x == k for x in to]
                taken = some.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place, pa.int32()), pa.array(own, pa.bool_()),
                     *[taken.column(n) for n in ("page_id", "url", "host", "path", "id")],
                     pa.array([digests[i] for i in at], pa.binary()), pa.array([packed[i] for i in at], pa.binary())],
                    names=["range", "own", "page_id", "url", *KEY, "lines"])

    def difference(table: pa.Table) -> pa.Table:
        here = table.column("range")[0].as_py()
        own, packed = table.column("own").to_pylist(), table.column("lines")
        found = list(zip(*(table.column(n).to_pylist() for n in KEY)))
        order = sorted(range(table.num_rows), key=found.__getitem__)
        keys = [found[i] for i in order]
        read = lambda k: [Line(*x) for x in json.loads(zlib.decompress(packed[order[k]].as_py()))]
        runs = _runs(keys)
        mine = [n for n, run in enumerate(runs) if own[order[run[0]]]]
        keep, texts = [], []
        for n in mine:
            run, near = runs[n], []
            start = begins.get(here, keys[run[0]][1]) if n == mine[0] else keys[run[0]][1]
            stop = ends.get(here, keys[run[-1]][1]) if n == mine[-1] else keys[run[-1]][1]
            host = keys[run[0]][0]
            if host and n and keys[runs[n - 1][-1]][0] == host:
                near.append((_common_start(keys[runs[n - 1][-1]][1], start), runs[n - 1][-1]))
            if host and n + 1 < len(runs) and keys[runs[n + 1][0]][0] == host:
                near.append((_common_start(stop, keys[runs[n + 1][0]][1]), runs[n + 1][0]))
            other = read(max(near, key=lambda x: x[0])[1]) if near else None
            text = before = None
            for k in run:
                if packed[order[k]] != before:
                    text, before = "\n".join(main_lines(read(k), other)), packed[order[k]]
                keep.append(order[k])
                texts.append(text)
        taken = table.take(pa.array(keep, pa.int64()))
        return pa.table({"page_id": taken.column("page_id"), "url": taken.column("url"),
                         "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())})

    return rows.mapInArrow(parse, columns).groupBy("range").applyInArrow(
        difference, f"page_id {kind}, url string, text string, n_chars long")
