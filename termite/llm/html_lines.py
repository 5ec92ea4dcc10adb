"""Lines of an HTML page: the text of its blocks, with where they stand."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
# Elements whose content is no text of the page.
SILENT = frozenset("script style noscript template svg annotation annotation-xml iframe object canvas audio video select "
                   "option button textarea title head".split())
RAW = frozenset("script style textarea title noscript iframe".split())
# All that a head holds: any other element, or text, ends it.
IN_HEAD = RAW | frozenset("head base link meta template".split())
CLOSED = re.compile(rf"""<(/?)({"|".join(sorted(SILENT - RAW - {"head"}, reverse=True))})(?=[\s/>])""", re.I)
# Elements that end a line where they begin and end.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section "
                   "summary table tbody td tfoot th thead tr ul".split())
# Elements that are followed to their end, with the parts of a page that are not its article.
PARTS = frozenset("nav footer aside form dialog menu header".split())
MAIN = frozenset("article main".split())
FOLLOWED = PARTS | MAIN | frozenset("div section ul ol li p table td body head fieldset details figure span".split())
# An open element that a beginning one ends, if none but these stand between.
ENDS = {"li": ("li", frozenset(("div", "p", "span", ""))), **{x: ("td", FOLLOWED - {"table"}) for x in ("td", "th", "tr")},
        **{x: ("p", frozenset(("span", ""))) for x in BLOCKS - {"li", "td", "th", "tr"}}}
REPLIES = frozenset("comment comments reply replies".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar".split())
NAMES = frozenset("ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner cookie cookies "
                  "consent gdpr notice notices alert newsletter subscribe subscription signup sidebar menu nav navbar "
                  "navigation breadcrumb breadcrumbs footer header masthead comment comments commentlist disqus reply replies "
                  "related recommended share sharing social popup modal overlay widget pagination pager toolbar".split())


class Line(NamedTuple):
    text: str
    main: bool    # inside the page's article
    aside: bool   # inside a menu, header, footer, sidebar, notice, advert, form or comments


def _names(attributes: str) -> tuple[set[str], str]:
    names, role = set(), ""
    for key, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if key.lower() == "role":
            role = value.strip()
        else:
            names.update(re.split(r"[^a-z0-9]+", value))
    return names, role


def _closed(page: str) -> set[int]:
    """Where the silent elements begin that are also closed."""
    found: set[int] = set()
    open_: dict[str, list[int]] = {}
    for m in CLOSED.finditer(page):
        begins = open_.setdefault(m[2].lower(), [])
        if not m[1]:
            begins.append(m.start())
        elif begins:
            found.add(begins.pop())
    return found


def _end_implied(stack: list[tuple], tag: str) -> None:
    """End the open element that a beginning ``tag`` ends."""
    ended, between = ENDS[tag]
    for i in range(len(stack) - 1, 0, -1):
        if stack[i][0] == ended:
            del stack[i:]
            return
        if stack[i][0] not in between:
            return


def lines(page: str) -> list[Line]:
    """The page's lines in order.  A tag that is never closed ends with the
    element around it, a paragraph, list item or cell with the next one, a head with
    the first element or text that is none of its own, a button or another element
    without text of the page with the next block; a stray ``<`` is text; a comment,
    script or style that is not closed runs to the end.

    A form or an element with a telling name may stand around the whole page
    ("has-sidebar"): those around the longest article tell nothing, and an article
    is aside only if more of them are around it (a teaser, a reply).  An inline
    element with a telling name leaves the rest of its block in one line."""
    out: list[tuple[int, str, int, bool, tuple]] = []  # block, text, article, aside, named
    # Tag, number of the article, aside whatever is inside, forms and telling names around by number, silent.
    stack: list[tuple[str, int, bool, tuple, bool]] = [("", -1, False, (), False)]
    articles: list[list] = []  # characters, forms and telling names around
    text: list[str] = []
    closed: set[int] | None = None
    block = 0

    def flush() -> None:
        if text:
            piece = html.unescape("".join(text))
            text.clear()
            _, article, aside, named, _ = stack[-1]
            out.append((block, piece, article, aside, named))
            if article >= 0 and not aside and named == articles[article][1]:
                articles[article][0] += len(" ".join(piece.split()))

    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        between = page[at:m.start() if m else n]
        if stack[-1][0] == "head" and between.strip():
            stack.pop()
        if not stack[-1][4]:
            text.append(between)
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS:
            flush()
            block += 1
            while stack[-1][0] == "" and len(stack) > 1:
                stack.pop()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    if stack[i - 1][1:4] != stack[-1][1:4]:
                        flush()
                    del stack[i:]
                    break
            continue
        if stack[-1][0] == "head" and tag not in IN_HEAD:
            stack.pop()
        if tag in ENDS:
            _end_implied(stack, tag)
        elif tag == "br":
            text.append(" ")
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in SILENT and not m[3].rstrip().endswith("/"):
            if closed is None:
                closed = _closed(page)
            stack.append((tag if tag == "head" or m.start() in closed else "", *stack[-1][1:4], True))
        elif tag in FOLLOWED:
            _, article, aside, named, silent = stack[-1]
            if tag == "body":
                silent = False
            names, role = _names(m[3]) if m[3] else (set(), "")
            if tag in MAIN or role == "main":
                articles.append([0, named])
                article, aside = len(articles) - 1, aside or bool(names & REPLIES)
            elif tag in PARTS - {"form"} and not (tag == "header" and article >= 0) or role in ROLES:
                aside = True
            elif tag == "form" or tag != "body" and names & NAMES:
                named = (*named, at)
            if (article, aside, named) != stack[-1][1:4]:
                flush()
            stack.append((tag, article, aside, named, silent))
    flush()
    around = max((x for x in articles if x[0]), key=lambda x: (x[0], -len(x[1])), default=(0, ()))[1]

    def beside(article: int, named: tuple) -> bool:
        if article < 0:
            return named != around[:len(named)]
        return len(named) > min(len(around), len(articles[article][1]))

    found: dict[tuple, list[str]] = {}
    for at_block, piece, article, aside, named in out:
        found.setdefault((at_block, article >= 0, aside or beside(article, named)), []).append(piece)
    joined = ((" ".join("".join(pieces).split()), main, aside) for (_, main, aside), pieces in found.items())
    return [Line(*x) for x in joined if x[0]]


def shared(a: list, b: list) -> list[bool]:
    """Which entries of ``a`` a longest common subsequence with ``b`` holds.

    Equal ends go first.  In between, one big integer a row of the table holds a
    bit an entry of ``a`` (a zero where the length grows), and the rows are read
    back.  A table of over 64 MB is halved first."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    return [True] * head + _middle(x, y) + [True] * tail


def _rows(x: list, y: list, keep: bool) -> list[int]:
    full = (1 << len(x)) - 1
    where: dict = {}
    for i, v in enumerate(x):
        where[v] = where.get(v, 0) | 1 << i
    row, rows = full, [full]
    for v in y:
        hit = row & where.get(v, 0)
        row = ((row + hit) | (row - hit)) & full
        if keep:
            rows.append(row)
    return rows if keep else [row]


def _middle(x: list, y: list) -> list[bool]:
    out = [False] * len(x)
    if not x or not y:
        return out
    if len(x) * len(y) > 1 << 29 and len(y) > 1:
        half = len(y) // 2
        ahead, back = _rows(x, y[:half], False)[0], _rows(x[::-1], y[half:][::-1], False)[0]
        best, at, left = -1, 0, 0
        right = [0] * (len(x) + 1)
        for i in range(len(x)):
            right[i + 1] = right[i] + (not back >> i & 1)
        for i in range(len(x) + 1):
            if left + right[len(x) - i] > best:
                best, at = left + right[len(x) - i], i
            left += i < len(x) and not ahead >> i & 1
        return _middle(x[:at], y[:half]) + _middle(x[at:], y[half:])
    rows = _rows(x, y, True)
    i, j = len(x), len(y)
    while i and j:
        if x[i - 1] == y[j - 1]:
            out[i - 1] = True
            i, j = i - 1, j - 1
        elif rows[j] >> (i - 1) & 1:
            i -= 1
        else:
            j -= 1
    return out
