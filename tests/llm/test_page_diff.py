"""Page lines, alignment, pairing, and the main text of small pages."""

import os
import random

import pytest

from small import tuples
from termite.llm.html_lines import lines, shared
from termite.llm.page_diff import extract


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_shared_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(14))] for _ in range(2))
        mask = shared(a, b)
        picked = [x for x, s in zip(a, mask) if s]
        assert len(mask) == len(a) and len(picked) == lcs(a, b)
        rest = iter(b)
        assert all(x in rest for x in picked)


def test_long_alignments_are_halved():
    rng = random.Random(2)
    a = [rng.randrange(40) for _ in range(24_000)]
    b = [x for x in a if rng.random() > 0.02]
    b[5:5] = [99]
    a[3:3] = [98]
    assert sum(shared(a, b[:23_400])) >= 23_000


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style><script>var t="</p>";</script></head><body class="promo">
<header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a><li>More</ul></nav><!-- ad <p>x</p> -->
<div class="cookie-notice">We use cookies</div><div class="ad">Buy</div>
{main}
<div id="comments"><p>First!</p><article class="comment">me too</article></div><aside>Side</aside>
<form><p>Name</p><input><button>Send</button></form><footer>&copy; site</footer></body></html>"""


@pytest.mark.parametrize("main, want", [
    ("<article><h1>A &amp; B</h1><p>one <b>two</b>\n three<p>4 < 5 &lt;x&gt;<br>end</article>", "A & B\none two three\n4 < 5 <x> end"),
    ("<main><header><h1>T</h1></header><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></main>", "T\nx\ny\n1\n2"),
    ("<article><p>in<aside>ad</aside>on</p></article>", "in\non"),
    ("<div><p>Plain page</p>loose</div>", "Plain page\nloose"),
    ("<article></article>", "")])
def test_one_page(spark, main, want):
    df = spark.createDataFrame([(1, "http://h/a", PAGE.format(main=main))], "page_id long, url string, html string")
    assert tuples(extract(df)) == [(1, "http://h/a", want, len(want))]


def test_lines_of_broken_pages():
    assert [x.text for x in lines("a<p>b</div>c<!-- open")] == ["a", "b", "c"]
    assert [x.text for x in lines("<p>x<script>if (a<b) {")] == ["x"]
    assert lines("") == [] and [x.text for x in lines("<")] == ["<"]
    assert [x.text for x in lines("<div title='a>b'>t</div>&#233;&nbsp; &bogus;")] == ["t", "é &bogus;"]


def undeclared(i, n):
    """Pages without any telling element: only the neighbours show what is shared."""
    return (f"<div>Welcome to the site</div><div>Menu one</div><div>Text {i} of page</div><div>Story {i}</div>"
            f"<div>Contact us</div>" if i < n else None)


@pytest.mark.parametrize("pages_a_range", [2000, 1, 3])
def test_shared_lines_go_whatever_the_ranges(spark, pages_a_range):
    rows = [(i, f"http://h{i % 2}.org/d{i % 5}/{i}", undeclared(i, 40)) for i in range(40)]
    rows += [(100, "http://alone.net/x", undeclared(3, 40)), (101, None, undeclared(4, 40)), (102, "odd", None)]
    got = {r[0]: r[2] for r in tuples(extract(spark.createDataFrame(rows, "page_id long, url string, html string"), pages_a_range))}
    assert len(got) == len(rows)
    for i in range(40):
        assert got[i] == f"Text {i} of page\nStory {i}"
    assert got[100].startswith("Welcome") and got[101].startswith("Welcome") and got[102] == ""


def test_copies_repeated_rows_and_odd_tables(spark):
    rows = [(1, "http://h/a", "<p>same</p><p>text</p>")] * 3 + [(None, "http://h/a", "<p>same</p><p>text</p>"), (2, "http://h/b", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 range", "2 own", "3 lines", "4 id")
    got = tuples(extract(df))
    assert [r[2] for r in got] == ["same\ntext"] * 3 + [""] + ["same\ntext"] or sorted(r[2] for r in got) == ["", *["same\ntext"] * 4]
    assert extract(df.limit(0)).count() == 0
    long = "<article>" + "".join(f"<p>{i} word</p>" for i in range(20_000)) + "</article>"
    df = spark.createDataFrame([(1, "http://h/a", long), (2, "http://h/b", long[:-20])], "page_id long, url string, html string")
    assert extract(df).where("n_chars > 200000").count() == 2


def test_alignment_decides_outside_a_declared_article(spark):
    """A page whose body is in blocks beside a small article keeps it; what is shared goes, in the article nothing does."""
    page = "<div>Welcome</div><div>Body {i}</div><article><p>Teaser</p><p>Card {i}</p></article><div>More {i}</div><div>Contact</div>"
    rows = [(i, f"http://h/d/{i}", page.format(i=i)) for i in range(4)]
    got = {r[0]: r[2] for r in tuples(extract(spark.createDataFrame(rows, "page_id long, url string, html string")))}
    assert got == {i: f"Body {i}\nTeaser\nCard {i}\nMore {i}" for i in range(4)}


@pytest.mark.parametrize("pages_a_range", [2000, 1, 3, 7])
def test_copies_are_compared_with_the_nearest_page_that_differs(spark, pages_a_range):
    """Groups of one to nine copies at adjacent URLs, over the ranges' borders; the last host has one group only."""
    sizes = [1, 3, 9, 2, 1, 1, 5, 4]
    group = [g for g, n in enumerate(sizes) for _ in range(n)]
    rows = [(i, f"http://h/d/{i:03}", undeclared(g, 99)) for i, g in enumerate(group)]
    rows += [(100 + i, f"http://i/d/{i:03}", undeclared(7, 99)) for i in range(6)]
    got = {r[0]: r[2] for r in tuples(extract(spark.createDataFrame(rows, "page_id long, url string, html string"), pages_a_range))}
    assert len(got) == len(rows)
    for i, g in enumerate(group):
        assert got[i] == f"Text {g} of page\nStory {g}"
    assert all(got[100 + i].startswith("Welcome") for i in range(6))


def pairing(rows):
    """Text of each page without telling elements, by scanning for the nearest pages that differ."""
    rows = sorted(rows, key=lambda r: r[1])
    page = [[x.text for x in lines(r[2])] for r in rows]
    out = {}
    for i, r in enumerate(rows):
        a = b = i
        while a and page[a - 1] == page[i]:
            a -= 1
        while b + 1 < len(rows) and page[b + 1] == page[i]:
            b += 1
        near = [(len(os.path.commonprefix([rows[x][1], rows[y][1]])), -s, y)
                for s, x, y in ((0, a, a - 1), (1, b, b + 1)) if 0 <= y < len(rows)]
        same = shared(page[i], page[max(near)[2]])
        out[r[0]] = "\n".join(x for x, s in zip(page[i], same) if not s)
    return out


@pytest.mark.parametrize("pages_a_range", [1, 2, 5])
def test_pairing_against_a_scan(spark, pages_a_range):
    rng = random.Random(6)
    rows = []
    for i in range(90):
        last = rows[-1][2] if rows else ""
        page = last if rng.random() < 0.7 and last else "".join(f"<p>{rng.randrange(12)}</p>" for _ in range(8))
        rows.append((i, f"http://h/{i // 9}/{i % 9 // 3}/{i:03}", page))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r[0]: r[2] for r in tuples(extract(df, pages_a_range))} == pairing(rows)


BODY = "<article><h1>A title</h1><p>The text of the article</p><div class='ad'>Buy</div><form>Name</form></article>"


@pytest.mark.parametrize("page, want", [
    ("<div class='layout has-sidebar'>{}<div class='sidebar'>Side</div></div>", []),
    ("<div id='content-sidebar-wrap'><form id='f'><main>{}</main></form></div>", []),
    ("<div class='has-sidebar'><main><h1>Top</h1><section class='with-menu'>{}</section></main></div>", ["Top"]),
    ("<div class='has-sidebar'>{}<div class='related'><article>Teaser</article></div></div>", []),
    ("<article>Card</article><div class='has-sidebar'>{}<div id='comments'><article>me too</article></div></div>", ["Card"]),
    ("{}<div class='related'><article>Teaser</article></div><aside><article>Teaser</article></aside>", []),
    ("<div class='has-sidebar'><article class='comment'>me too and a lot more of it, and more</article>{}</div>", [])])
def test_wrappers_with_telling_names_keep_the_article(page, want):
    assert [x.text for x in lines(page.format(BODY)) if x.main and not x.aside] == want + ["A title", "The text of the article"]


def test_wrappers_with_telling_names_keep_the_lines_beside_the_article():
    page = f"<div class='ad'>Buy</div><div class='has-sidebar'><p>Lead</p>{BODY}<div class='sidebar'>Side</div></div><div class='widget'>W</div>"
    assert [x.text for x in lines(page) if not x.aside] == ["Lead", "A title", "The text of the article"]


@pytest.mark.parametrize("page, want", [
    ("<html><head><title>No</title><meta charset=x><p>One<p>Two", ["One", "Two"]),
    ("<head>loose<div>block</div>", ["loose", "block"]),
    ("<div><button>Send<p>rest</p>more</div>tail", ["rest", "more", "tail"]),
    ("<p>a <button>x</button> b <svg><svg></svg>y</svg> c<p>d", ["a b c", "d"]),
    ("<select><option>a<option>b</select> on <option>c<p>d", ["on", "d"]),
    ("<article>one<p class='ad'>Buy<p>two<p class='cookie-notice'>We</p>three</article>", ["one", "two", "three"]),
    ("<article><ul><li class='comment'>me<ul><li>too</ul><li>kept</ul><article class='reply'>re</article></article>", ["kept"]),
    ("<ul><li class='ad'><p>Buy</p><div>now</div><li>kept<ul><li>inner</li></ul></li></ul>", ["kept", "inner"]),
    ("<table><tr><td class='ad'>Buy<td>one<tr><td class='ad'>Buy<tr><th>two</table>", ["one", "two"]),
    ("<p>We <span>really</span> like <span class='ad'>Buy</span> this <b>one</b></p><p>too", ["We really like this one", "too"]),
    ("<article>so <math><mi>x</mi><annotation>\\x</annotation></math> is</article>", ["so x is"])])
def test_elements_without_an_end_and_telling_names_on_any_block(page, want):
    assert [x.text for x in lines(page) if not x.aside] == want


def test_many_elements_without_an_end():
    page = "<p>a" + "<button>b<li>c" * 20_000
    assert len(lines(page)) == 20_001
