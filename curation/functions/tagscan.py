"""Linear scans of one HTML document: readable text, title, meta tags.

The rules are those of these searches (case-insensitive, ``.`` takes line
ends), where the first match from the left counts:

- script and style elements ``<(script|style)[^>]*>.*?</\\1>``, line breaks
  ``<br\\s*/?>`` and ``</p\\s*>``, other tags ``<[^>]+>``
- ``<title[^>]*>(.*?)</title>``
- for a meta name N: ``<meta[^>]+name=["']N["'][^>]+content=["'](.*?)["']``,
  the same with ``property=``, then
  ``<meta[^>]+content=["'](.*?)["'][^>]+(?:name|property)=["']N["']``

Run as they stand they look at the rest of the page again from every ``<``, so
a page of unclosed tags takes quadratic time.  The scans below find the same
matches and look at each part of the page a bounded number of times: a search
that failed is not made again further right.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterable

_RAW = re.compile(r"<(script|style)", re.I)
_RAW_END = {k: re.compile(f"</{k}>", re.I) for k in ("script", "style")}
_BREAK = re.compile(r"<br\s*/?>", re.I)
_PARAGRAPH_END = re.compile(r"</p\s*>", re.I)
_TAG = re.compile(r"<[^>]+>")
_SPACES = re.compile(r"\s+")
_TITLE = re.compile(r"<title", re.I)
_TITLE_END = re.compile(r"</title>", re.I)
_META = re.compile(r"<meta", re.I)
_CONTENT = re.compile(r"""content=["']""", re.I)
_QUOTE = re.compile(r"""["']""")


def without_scripts(page: str) -> str:
    """Script and style elements as blanks."""
    out, done, at = [], 0, 0
    open_kinds = {"script", "style"}  # kinds that still close further right
    while open_kinds:
        m = _RAW.search(page, at)
        if m is None:
            break
        # the kind by its second letter: other letters may fold onto "s"
        kind = "style" if m.group(1)[1] in "tT" else "script"
        at = m.end()
        if kind not in open_kinds:
            continue
        gt = page.find(">", at)
        if gt < 0:
            break
        end = _RAW_END[kind].search(page, gt + 1)
        if end is None:
            open_kinds.discard(kind)
            continue
        out += (page[done:m.start()], " ")
        done = at = end.end()
    return page if not out else "".join(out) + page[done:]


def without_tags(page: str) -> str:
    """Line breaks for ``<br>`` and ``</p>``, a blank for any other tag."""
    page = _PARAGRAPH_END.sub("\n", _BREAK.sub("\n", without_scripts(page)))
    last = page.rfind(">") + 1  # no tag ends behind here
    return _TAG.sub(" ", page[:last]) + page[last:]


def one_line(text: str) -> str:
    return _SPACES.sub(" ", text).strip()


def text_of(page: str) -> str:
    """Readable text: one line for each line that is not blank."""
    lines = (one_line(x) for x in html.unescape(without_tags(page)).splitlines())
    return "\n".join(x for x in lines if x)


def title_element(page: str) -> str:
    """Text of the first title element, or an empty text."""
    m = _TITLE.search(page)
    gt = page.find(">", m.end()) if m else -1
    end = _TITLE_END.search(page, gt + 1) if gt >= 0 else None
    return html.unescape(one_line(page[gt + 1:end.start()])) if end else ""


class MetaTags:
    """Meta tags of a page, found once for all names.

    A tag reaches from ``<meta`` to the next ``>``; a second ``<meta`` within
    it begins no other tag, as whatever follows matches from the first."""

    def __init__(self, page: str):
        self.page = page
        self.no_quote = len(page)  # no quote from here on
        self.tags: list[tuple[int, int, list]] = []  # start, end, starts and ends of content=
        end = -1
        for m in _META.finditer(page):
            if m.start() < end:
                continue
            end = page.find(">", m.end())
            end = len(page) if end < 0 else end
            self.tags.append((m.end(), end, [(c.start(), c.end()) for c in _CONTENT.finditer(page, m.end() + 1, end)]))

    def _quote(self, at: int) -> int:
        m = _QUOTE.search(self.page, at) if at < self.no_quote else None
        if m is None:
            self.no_quote = min(self.no_quote, at)
            return -1
        return m.start()

    def _behind(self, attribute: str, name: str) -> str | None:
        """The content that follows ``attribute="name"`` in a tag."""
        wanted = re.compile(rf"""{attribute}=["']{re.escape(name)}["']""", re.I)
        for start, end, contents in self.tags:
            if not contents:
                continue
            named = [m.end() for m in wanted.finditer(self.page, start + 1, end)]
            # the last content that a quote ends; at most the last two are tried
            for c0, c1 in reversed(contents if named else []):
                q = self._quote(c1)
                if q >= 0:
                    if named[0] < c0:
                        return self.page[c1:q]
                    break
        return None

    def _before(self, name: str) -> str | None:
        """The content before ``name="name"`` or ``property="name"``: up to
        the first quote with such an attribute behind it and no ``>`` between
        (which may lie in a later tag)."""
        if not any(c for *_, c in self.tags):
            return None
        page, first, last = self.page, [], []
        gt = at = q = -1  # the last ">" before the attribute, the last quote with a sign between
        for m in re.compile(rf"""(?:name|property)=["']{re.escape(name)}["']""", re.I).finditer(page):
            was, at = max(at, 0), max(m.start() - 1, 0)
            gt = max(gt, page.rfind(">", was, m.start()))
            q = max(q, page.rfind('"', was, at), page.rfind("'", was, at))
            if q > gt:
                first.append(gt + 1)
                last.append(q)
        for _, _, contents in self.tags:
            for _, c1 in reversed(contents):
                k = bisect_left(last, c1)
                if k < len(last):
                    return page[c1:self._quote(max(c1, first[k]))]
        return None

    def content(self, names: Iterable[str]) -> str:
        """Decoded content of the first name that any of the searches finds,
        even if it is empty."""
        for name in names if self.tags else ():
            found = self._behind("name", name)
            found = self._behind("property", name) if found is None else found
            found = self._before(name) if found is None else found
            if found is not None:
                return html.unescape(one_line(found))
        return ""

    def content_behind(self, names: Iterable[str]) -> str:
        """As ``content``, but a name with a colon is looked for as property
        alone, others as name alone, each before its content."""
        for name in names if self.tags else ():
            found = self._behind("property" if ":" in name else "name", name)
            if found is not None:
                return html.unescape(one_line(found))
        return ""
