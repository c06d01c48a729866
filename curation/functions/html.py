"""HTML column expressions: readable text, title, meta tags, embeds.

A document is scanned in one ``arrow_udf`` (``tagscan``, by slices) for
all that is asked of it: the full HTML5 table of entities needs Python in any
case, and the scans are linear in the page, which the rules as JVM regexes are
not.  What is short (embeds, tests of a page's beginning) stays in the JVM.
"""

from __future__ import annotations

import html as _html
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from curation.functions import tagscan
from curation.functions.slices import text_udf
from curation.functions.text import SPACE, collapse_ws


def _unescape_one(x):
    if x is None or "&" not in x:
        return x
    return _html.unescape(x)


_unescape_batch = text_udf(_unescape_one, StringType())


def unescape(c: Column) -> Column:
    """``html.unescape`` (named, numeric and legacy entities).

    The input is referenced exactly once (it is usually a long regex chain
    that must not be evaluated twice); rows without "&" return unchanged on
    the Python side without calling the decoder."""
    return _unescape_batch(c)


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def _scan(make: Callable[[str], str]):
    """A column function from a function of one page (null stays null)."""
    return text_udf(lambda x: None if x is None else make(x), StringType())


def html_to_text(raw: Column) -> Column:
    """Readable text of an HTML document, one non-blank line per line."""
    return _scan(tagscan.text_of)(raw)


def meta_content(raw: Column, names: Iterable[str]) -> Column:
    """Decoded, whitespace-collapsed content of the first matching meta tag.

    Names are tried in order, each with three attribute orders; the first
    that matches anywhere wins even if its content is empty."""
    names = list(names)
    return F.coalesce(_scan(lambda x: tagscan.MetaTags(x).content(names))(raw), F.lit(""))


TITLE_NAMES = ["og:title", "twitter:title"]
DESCRIPTION_NAMES = ["description", "og:description", "twitter:description"]
# Variant used by the collector: og:description first, then description.
COLLECTOR_DESCRIPTION_NAMES = ["og:description", "description"]


def title_tag(raw: Column) -> Column:
    """Text of the first ``<title>`` element, collapsed and decoded."""
    return F.coalesce(_scan(tagscan.title_element)(raw), F.lit(""))


def _title_of(page: str) -> str:
    return tagscan.MetaTags(page).content(TITLE_NAMES) or tagscan.title_element(page)


def page_title(raw: Column) -> Column:
    """``og:title`` / ``twitter:title`` meta, else ``<title>``."""
    return F.coalesce(_scan(_title_of)(raw), F.lit(""))


def _parts_of(page: str | None) -> dict:
    if page is None:
        return {"title": "", "description": "", "text": None}
    meta = tagscan.MetaTags(page)
    return {"title": meta.content(TITLE_NAMES) or tagscan.title_element(page),
            "description": meta.content(DESCRIPTION_NAMES), "text": tagscan.text_of(page)}


_page_parts = text_udf(_parts_of, _strings("title", "description", "text"))


def page_parts(raw: Column) -> Column:
    """struct(title, description, text) of an HTML document in one scan."""
    return _page_parts(raw)


def _collected_of(page: str | None) -> dict:
    if page is None:
        return {"title": "", "desc": ""}
    return {"title": tagscan.title_element(page), "desc": tagscan.MetaTags(page).content_behind(COLLECTOR_DESCRIPTION_NAMES)}


_collected = text_udf(_collected_of, _strings("title", "desc"))


def collector_meta(raw: Column) -> Column:
    """Collector page metadata: struct(title from <title>, desc og-first)."""
    return _collected(raw)


def looks_like_html(raw: Column) -> Column:
    """``"<html"`` in the first 500 or ``"<title"`` in the first 2000 chars."""
    return ((F.instr(F.lower(F.substring(raw, 1, 500)), "<html") > 0)
            | (F.instr(F.lower(F.substring(raw, 1, 2000)), "<title") > 0))


def embed_text(raw: Column) -> Column:
    """Embed markup to text: tags to spaces, decode, collapse whitespace."""
    t = F.regexp_replace(raw, r"<[^<]+?>", " ")
    return collapse_ws(unescape(t))


def short_title(text: Column, n: int = 70) -> Column:
    """First ``n`` chars plus "..." when longer."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)


Cleaner = Callable[[Column], Column]


def clean_body(raw: Column, cleaner: Cleaner | None = None, min_chars: int = 120, builtin: Column | None = None) -> Column:
    """struct(text, cleaner): a pluggable extractor is used when it yields at
    least ``min_chars`` stripped chars, else the built-in ``html_to_text``
    (or its result ``builtin``, where that is known)."""
    text = html_to_text(raw) if builtin is None else builtin
    builtin = F.struct(text.alias("text"), F.lit("html_to_text").alias("cleaner"))
    if cleaner is None:
        return builtin
    ext = F.regexp_replace(cleaner(raw), f"^{SPACE}+|{SPACE}+$", "")
    return F.when(F.length(ext) >= min_chars,
                  F.struct(ext.alias("text"), F.lit("custom").alias("cleaner"))).otherwise(builtin)
