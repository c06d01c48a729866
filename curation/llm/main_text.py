"""Operator 12: the main text of web pages.

The standard library's parser is fed piece by piece (a tag, a run of text) and
its events build lines: a line is a block of the page, with its text and the
tags it took.  A line's ratio is its characters by its tags.  The ratios are
smoothed by a Gaussian over neighbouring lines, and lines at or above a
threshold (a share of the ratios' standard deviation) cluster into content.

Regions: the content lines choose the region.  If the page marks articles (or
a main part), those that hold content lines are the regions; otherwise the
deepest element that holds most of the content's characters (the body itself
is cut to the span of its content lines).  Within a region every line is kept,
however short, unless it lies in something that is no article text: menus,
headers, footers, sidebars, forms, scripts, styles, hidden parts, and elements
whose class, id or role names an advert, a notice, comments or the like.  A
header within an article stays, as it holds the title.

Hostile pages: a piece is cut by searches that never look at a part of the
page twice; a tag of more than ``LONG_TAG`` signs, or with a quote that never
ends, is given to the parser without attributes.  So time is linear in the page.

Scale: one pass without a shuffle; a row is worked on alone.

Defined results: a null or empty page, or one without text, gives an empty text
of 0 characters; an element that is never closed excludes lines only up to the
first article, main part or heading within it; other columns pass unchanged
(own columns named ``text`` and ``n_chars`` are replaced); repeated rows are
each extracted; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import table

LONG_TAG = 1 << 13
#: Standard deviation of the Gaussian in lines, and the threshold in standard
#: deviations of the smoothed ratios.
SMOOTH, THRESHOLD = 1.0, 0.5
#: Share of the content's characters that a region without marks holds.
REGION_SHARE = 0.8
#: Share of a line's characters within links from which on it is a menu,
#: outside of marked articles.
LINK_SHARE = 0.5

# Element names of HTML by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MUTE = frozenset("head title script style noscript template textarea select option svg math iframe object canvas "
                 "audio video button datalist".split())
DROP = frozenset("nav footer aside form dialog menu search".split())
REGION = frozenset("article main".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup p pre search section "
                  "summary table tbody tfoot thead caption tr ul".split())
CONTAINERS = frozenset(["", *"body div section center".split()])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag that ends an open element of the same kind.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",)}
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar "
                       "toolbar status".split())
#: Words of a class or id that name a head, which an article may have itself,
#: those that tell it is an article's, and those of what is no article text.
HEAD_HINTS = frozenset("header masthead".split())
CONTENT_WORDS = frozenset("article post entry story content".split())
HINTS = frozenset("ad ads adv advert adverts advertisement advertising adbox adsense adslot sponsor sponsored sponsors promo "
                  "promoted promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
                  "subscribe subscription signup login paywall share sharing social related recommended recommendations "
                  "comment comments disqus replies respond sidebar menu nav navbar navigation breadcrumb breadcrumbs footer "
                  "topbar widget widgets toolbar pagination pager teaser teasers outbrain taboola "
                  "skip disclaimer".split())
#: The same as the beginning or end of a longer word.
STEMS = ("comments", "sidebar", "advert", "cookie", "newsletter", "sponsor", "footer")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_START = re.compile(r"""<[a-zA-Z][^\s/>]*+(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_SIGNS = re.compile("<+")
_NAME = re.compile(r"</?[a-zA-Z][^\s/>]*")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style", "title", "textarea")}


def pieces(page: str) -> Iterator[str]:
    """Runs of text, tags and comments of a page, in order; each is found
    without looking at what follows it twice."""
    at, n, quoted = 0, len(page), True
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield page[at:]
            return
        if lt > at:
            yield page[at:lt]
        nxt = page[lt + 1:lt + 2]
        if page.startswith("<!--", lt):
            if page.startswith(("<!-->", "<!--->"), lt):
                at = page.find(">", lt) + 1
                continue
            end = page.find("-->", lt + 4)
            if end < 0:
                return
            at = end + 3
        elif nxt.isascii() and nxt.isalpha():
            m = _START.match(page, lt) if quoted else None
            if m is None:
                quoted = False  # no quote or tag closes behind here: the next sign ends a tag
                end = page.find(">", lt)
                if end < 0:
                    return
                at = end + 1
            else:
                at = m.end()
            name = _NAME.match(page, lt).group()[1:].lower()
            yield page[lt:at] if m is not None and at - lt <= LONG_TAG else f"<{name[:100]}>"
            if name in _RAW_END:
                m = _RAW_END[name].search(page, at)
                if m is None:
                    return
                at = m.start()
        elif nxt in ("/", "!", "?") and nxt:
            end = page.find(">", lt)
            if end < 0:
                return
            m = _NAME.match(page, lt)
            if m:
                yield f"{m.group()[:100]}>"
            at = end + 1
        else:  # a run of these: all but the last are signs
            at = _SIGNS.match(page, lt).end()
            at = max(lt + 1, at - 1)
            yield "&lt;" * (at - lt)


class Lines(HTMLParser):
    """Elements and lines of a page from the parser's events.

    An element is (parent, tag, drop); drop is 0, 1 (by its tag or role), 2
    (by its class or id) or 3 (a head, by its class or id).  A line is [element,
    text, tags, characters in links, heading]."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.drop = [0], [""], [0]
        self.open = [0]
        self.held = Counter()
        self.mute: list[str] = []
        self.silent = ""  # an open inline element that is no article text
        self.links = 0
        self.lines: list[list] = []
        self.text: list[str] = []
        self.tags = self.linked = 0

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append([self.open[-1], text, self.tags, self.linked, self.tag[self.open[-1]] in HEADINGS])
            self.tags = 0
        self.text, self.linked = [], 0

    def _pop(self, to: int) -> None:
        for e in self.open[to:]:
            self.held[self.tag[e]] -= 1
        del self.open[to:]

    def _close(self, tags: tuple[str, ...], barrier: tuple[str, ...] = ()) -> None:
        if any(self.held[t] for t in tags):
            for i in range(len(self.open) - 1, 0, -1):
                tag = self.tag[self.open[i]]
                if tag in tags:
                    self._pop(i)
                    return
                if tag in barrier:
                    return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
        if tag in ("td", "th"):
            self.text.append(" ")
        if tag in VOID and tag != "hr":
            return
        if tag in MUTE:
            self.mute.append(tag)
            return
        if tag == "a":
            self.links = 1
        drop = self._drop(tag, attrs)
        if tag not in BLOCK:
            if drop and not self.silent:
                self.silent = tag
            return
        if tag in BLOCK:
            self.flush()
            if self.mute == ["head"] or tag == "body" or (tag in REGION and not {"noscript", "template"} & {*self.mute}):
                self.mute.clear()
            self.silent, self.links = "", 0
            self._close(("p",), ("article", "main", "section", "div", "li", "td"))
            if tag in HEADINGS:
                self._close(tuple(HEADINGS), ("article", "main", "section", "div", "header"))
            if tag in CLOSES:
                self._close(CLOSES[tag], ("ul", "ol", "dl", "table"))
            if tag == "hr":
                return
        self.parent.append(self.open[-1])
        self.tag.append(tag)
        self.drop.append(drop)
        self.open.append(len(self.tag) - 1)
        self.held[tag] += 1

    def handle_startendtag(self, tag, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag in MUTE or (tag not in BLOCK and tag not in VOID):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "a":
            self.links = 0
        if tag in MUTE:
            if tag in self.mute:
                del self.mute[self.mute.index(tag):]
            return
        if tag in ("td", "th"):
            self.text.append(" ")
        if tag == self.silent:
            self.silent = ""
        if tag in BLOCK:
            self.silent = ""
            self.flush()
            self._close((tag,))

    def handle_data(self, data: str) -> None:
        if not self.mute and not self.silent:
            self.text.append(data)
            if self.links:
                self.linked += len(data)

    def _drop(self, tag: str, attrs: list[tuple[str, str | None]]) -> int:
        if tag in DROP or tag == "header":
            return 1
        drop = 0
        for k, v in attrs:
            if k == "hidden" or (k == "aria-hidden" and v == "true") or (k == "style" and v and re.search(r"display\s*:\s*none", v)):
                return 1
            if k == "role" and v and v.lower() in DROP_ROLES:
                return 1
            if k in ("class", "id") and v and tag not in ("html", "body"):
                for name in v.split():
                    if tag in REGION:
                        drop = max(drop, 2 * (name.lower() in HINTS))
                    elif not name.startswith(("has-", "with-", "no-")):
                        words = {w.lower() for w in _WORD.findall(name)}
                        if words & HINTS or any(w.startswith(STEMS) or w.endswith(STEMS) for w in words):
                            drop = 2
                        elif words & HEAD_HINTS and not words & CONTENT_WORDS:
                            drop = max(drop, 3 * (drop == 0))
        return drop


def _excluded(page: Lines, hints: bool) -> list[bool]:
    """Whether lines of each element are out."""
    n = len(page.tag)
    still = set(page.open)  # never closed
    marks = [e for e in range(1, n) if page.tag[e] in REGION or page.tag[e] == "h1"]
    article, out = [False] * n, [False] * n
    until = [0] * n  # elements before this one are out
    for e in range(1, n):
        up, kind = page.parent[e], page.drop[e]
        article[e] = article[up] or page.tag[e] in REGION
        drop = kind and (hints or kind == 1)
        if drop and article[up] and (kind == 3 or (page.tag[e] == "header" and kind == 1)):
            drop = False
        out[e], until[e] = out[up], until[up]
        if drop and e in still:
            k = bisect_right(marks, e)
            until[e] = max(until[up], marks[k] if k < len(marks) else n)
        elif drop:
            out[e] = True
    return [out[e] or e < until[e] for e in range(n)]


def smoothed(ratio: np.ndarray, sigma: float = SMOOTH) -> np.ndarray:
    """Ratios under a Gaussian over neighbouring lines."""
    r = int(3 * sigma) + 1
    kernel = np.exp(-np.arange(-r, r + 1) ** 2 / (2 * sigma * sigma))
    weight = np.convolve(np.ones(len(ratio)), kernel)[r:-r]
    return np.convolve(ratio, kernel)[r:-r] / weight


def _region(page: Lines, out: list[bool]) -> list[int]:
    """Indexes of the lines of the page's main text."""
    lines = page.lines
    live = [i for i, x in enumerate(lines) if not out[x[0]]]
    if not live:
        return []
    size = np.array([len(x[1]) for x in lines], float)
    smooth = smoothed(np.array([len(x[1]) / max(1, x[2]) for x in lines]))
    high = smooth >= THRESHOLD * smooth.std()
    content = [i for i in live if high[i] and lines[i][3] <= LINK_SHARE * size[i]] or live
    n = len(page.tag)
    # the outermost article, or else main part, of each element
    article, main = [0] * n, [0] * n
    for e in range(1, n):
        up = page.parent[e]
        article[e] = article[up] or (e if page.tag[e] == "article" else 0)
        main[e] = main[up] or (e if page.tag[e] == "main" else 0)
    for mark in (article, main):
        some = {mark[lines[i][0]] for i in content} - {0} or {mark[lines[i][0]] for i in live} - {0}
        if some:
            first = min(i for i in live if mark[lines[i][0]] in some)
            head = []  # a title right above the article, within the same main part
            if mark is article and main[lines[first][0]]:
                head = [i for i in live if i < first and lines[i][4] and main[lines[i][0]] == main[lines[first][0]]]
            return head + [i for i in live if mark[lines[i][0]] in some]
    mass, held = [0.0] * n, [0] * n
    for i in content:
        mass[lines[i][0]] += size[i]
    for i in live:
        held[lines[i][0]] += 1
    for e in range(n - 1, 0, -1):
        mass[page.parent[e]] += mass[e]
        held[page.parent[e]] += held[e]
    # one long block is no region by itself
    root = max((e for e in range(n) if mass[e] >= REGION_SHARE * mass[0] and held[e] > 1 and page.tag[e] in CONTAINERS), default=0)
    inside = [False] * n
    for e in range(n):
        inside[e] = e == root or (e > 0 and inside[page.parent[e]])
    if page.tag[root] not in ("", "html", "body"):
        return [i for i in live if inside[lines[i][0]] and lines[i][3] <= LINK_SHARE * size[i]]
    within = [i for i in content if inside[lines[i][0]]]
    first, last = within[0], within[-1]
    while first > 0 and lines[first - 1][4] and not out[lines[first - 1][0]]:
        first -= 1  # headings right above
    return [i for i in live if first <= i <= last and inside[lines[i][0]] and lines[i][3] <= LINK_SHARE * size[i]]


def main_text(html: str | None) -> str:
    """The article's blocks, joined by line feeds."""
    page = Lines()
    for piece in pieces(html or ""):
        page.feed(piece)
        if page.rawdata and piece[0] == "<":  # the parser waits for more of this tag: none will come
            page.rawdata = ""
            page.feed(_NAME.match(piece).group() + ">")
    page.close()
    page.flush()
    keep = _region(page, _excluded(page, True)) or _region(page, _excluded(page, False))
    return "\n".join(page.lines[i][1] for i in keep)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without the html column, with ``text`` and ``n_chars``."""
    keep = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch.column(batch.schema.get_field_index(html_col))
            text = [main_text(x.as_py()) for x in html]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(text, pa.string()),
                 pa.array([len(t) for t in text], pa.int64())], names=[*keep, "text", "n_chars"])

    schema = T.StructType([*(pages.schema[c] for c in keep), T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    return pages.select(*keep, html_col).mapInArrow(run, schema)


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all ``pages``."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


#: The marked article of pages as given: its blocks without tags, with the
#: character references that those pages hold.
OP12_SQL = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(html, '(?s)<article>(.*?)(?:</article>|\z)', 1) AS body FROM pages),
b AS (
  SELECT page_id, url, list_filter(list_transform(string_split_regex(body, '</?(?:p|h1)>'), lambda x:
    trim(regexp_replace(replace(replace(replace(replace(regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g'),
      '&quot;', '"'), '&copy;', chr(169)), '&middot;', chr(183)), '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks
  FROM a),
t AS (SELECT page_id, url, coalesce(array_to_string(blocks, chr(10)), '') AS text FROM b)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM t
"""
