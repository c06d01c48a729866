"""RSS / Atom feeds and starred-repo JSON pages to sources.

Each landed document is parsed with Spark's native ``from_xml`` /
``from_json`` (explicit schemas, PERMISSIVE), exploded with its position so
document order survives, limited per feed with a group-limited window
(W6) and mapped to the sources schema.  A malformed document lands in
``_corrupt_record`` and becomes a warning row instead of failing the run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curation.functions import html as H
from curation.functions.text import collapse_ws, py_strip
from curation.functions.urls import canonical_url
from curation.operators.topk import limit_per_feed

RSS_SCHEMA = ("channel struct<title:string, item:array<struct<title:string, link:string, guid:string, "
              "pubDate:string, published:string, updated:string, description:string, summary:string, "
              "content:string, encoded:string>>>, "
              "item array<struct<title:string, link:string, guid:string, pubDate:string, published:string, "
              "updated:string, description:string, summary:string, content:string, encoded:string>>, "
              "_corrupt_record string")
ATOM_SCHEMA = ("title string, entry array<struct<title:string, link:array<struct<_href:string,_rel:string>>, "
               "published:string, updated:string, description:string, summary:string, content:string, "
               "encoded:string>>, _corrupt_record string")
REPOS_SCHEMA = ("array<struct<html_url:string, full_name:string, name:string, description:string, "
                "topics:array<string>, language:string, stargazers_count:bigint>>")
DEFAULT_FEED_LIMIT = 20


def _text(c: Column) -> Column:
    """Child text as the reference reads it: stripped, then entity-decoded."""
    s = py_strip(F.coalesce(c, F.lit("")))
    return H.unescape(s)


def _first_nonempty(*cols: Column) -> Column:
    expr = None
    for c in cols:
        t = _text(c)
        expr = F.when(t != "", t) if expr is None else expr.when(t != "", t)
    return expr.otherwise(F.lit(""))


def item_body(desc: Column, published: Column) -> Column:
    """Description-like text (HTML stripped when it looks like markup,
    else whitespace-collapsed) and the published string, newline-joined."""
    def clean(p: Column) -> Column:
        markup = (F.instr(p, "<") > 0) & (F.instr(p, ">") > 0)
        c = F.when(markup, H.html_to_text(p)).otherwise(collapse_ws(p))
        return F.when(c != "", c)
    return F.concat_ws("\n", clean(desc), clean(published))


def parse_rss(feeds: DataFrame) -> DataFrame:
    """``feeds(feed_id, feed_url, xml)`` -> one row per ``<item>`` with its
    position: ``<channel>`` items, else root-level items."""
    p = feeds.select("feed_id", "feed_url", F.from_xml("xml", RSS_SCHEMA, {"mode": "PERMISSIVE", "ignoreNamespace": "true"}).alias("p"))
    items = F.when(F.size(F.coalesce(F.col("p.channel.item"), F.array())) > 0, F.col("p.channel.item")) \
        .otherwise(F.col("p.item"))
    out = p.filter(F.col("p._corrupt_record").isNull()).select(
        "feed_id", "feed_url", _text(F.col("p.channel.title")).alias("feed_title"),
        F.posexplode(items).alias("pos", "it"))
    link = _text(F.col("it.link"))
    guid = _text(F.col("it.guid"))
    url = F.when(link != "", link).when(guid.startswith("http://") | guid.startswith("https://"), guid) \
        .otherwise(F.lit(""))
    return out.select("feed_id", "feed_url", "feed_title", "pos", url.alias("url"),
                      _text(F.col("it.title")).alias("item_title"),
                      _first_nonempty(F.col("it.pubDate"), F.col("it.published"), F.col("it.updated"))
                      .alias("published"),
                      _first_nonempty(F.col("it.description"), F.col("it.summary"), F.col("it.content"),
                                      F.col("it.encoded")).alias("desc"))


def parse_atom(feeds: DataFrame) -> DataFrame:
    """``feeds(feed_id, feed_url, xml)`` -> one row per ``<entry>``; the URL is
    the first alternate link (a missing rel counts as alternate), else the
    first link with an href."""
    p = feeds.select("feed_id", "feed_url", F.from_xml("xml", ATOM_SCHEMA, {"mode": "PERMISSIVE", "ignoreNamespace": "true"}).alias("p"))
    out = p.filter(F.col("p._corrupt_record").isNull()).select(
        "feed_id", "feed_url", _text(F.col("p.title")).alias("feed_title"),
        F.posexplode(F.col("p.entry")).alias("pos", "e"))
    links = F.filter(F.coalesce(F.col("e.link"), F.array()), lambda l: py_strip(F.coalesce(l["_href"], F.lit(""))) != "")
    alt = F.filter(links, lambda l: F.lower(F.coalesce(l["_rel"], F.lit("alternate"))) == "alternate")
    url = F.coalesce(py_strip(F.try_element_at(alt, F.lit(1))["_href"]),
                     py_strip(F.try_element_at(links, F.lit(1))["_href"]), F.lit(""))
    return out.select("feed_id", "feed_url", "feed_title", "pos", url.alias("url"),
                      _text(F.col("e.title")).alias("item_title"),
                      _first_nonempty(F.col("e.published"), F.col("e.updated")).alias("published"),
                      _first_nonempty(F.col("e.description"), F.col("e.summary"), F.col("e.content"),
                                      F.col("e.encoded")).alias("desc"))


def feed_sources(items: DataFrame, feeds: DataFrame, method: str = "feed_fetch") -> DataFrame:
    """Items -> sources: first ``limit`` valid items per feed, title falls
    back to the URL, metadata carries feed URL / title / published.
    ``feeds(feed_id, limit, priority)``."""
    lim = feeds.select("feed_id", F.coalesce("limit", F.lit(DEFAULT_FEED_LIMIT)).alias("limit"),
                       F.coalesce("priority", F.lit(0)).alias("priority"))
    kept = limit_per_feed(items, lim)
    meta = F.map_concat(
        F.create_map(F.lit("feed_url"), F.col("feed_url")),
        F.when(F.col("feed_title") != "", F.create_map(F.lit("feed_title"), F.col("feed_title")))
        .otherwise(F.create_map().cast("map<string,string>")),
        F.when(F.col("published") != "", F.create_map(F.lit("published"), F.col("published")))
        .otherwise(F.create_map().cast("map<string,string>")))
    return kept.select(
        "feed_id", "pos", "url", canonical_url(F.col("url")).alias("canonical_url"),
        F.when(F.col("item_title") != "", F.col("item_title")).otherwise(F.col("url")).alias("title"),
        item_body(F.col("desc"), F.col("published")).alias("body"),
        F.lit("rss_feed").alias("source_type"), F.lit(method).alias("method"), "priority",
        F.array().cast("array<string>").alias("errors"), meta.alias("metadata"))


def feed_diagnostics(configs: DataFrame, fetched: DataFrame) -> DataFrame:
    """Warnings instead of failures.  ``configs(idx, url, limit)`` in
    config order (1-based ``idx``); ``fetched(feed_url, xml)``.  Missing URL
    -> ``rss_feed_skipped:{idx}: missing url``; ``limit <= 0`` -> silently
    skipped; unparsable XML -> ``rss_feed_failed:{url}: {reason}``."""
    missing = configs.filter(F.col("url").isNull() | (F.col("url") == "")).select(
        "idx", F.concat(F.lit("rss_feed_skipped:"), F.col("idx"), F.lit(": missing url")).alias("warning"))
    live = configs.filter((F.col("url") != "") & (F.coalesce("limit", F.lit(DEFAULT_FEED_LIMIT)) > 0))
    parsed = fetched.select("feed_url", F.from_xml("xml", RSS_SCHEMA, {"mode": "PERMISSIVE", "ignoreNamespace": "true"}).alias("p"))
    bad = parsed.filter(F.col("p._corrupt_record").isNotNull()).select("feed_url")
    failed = live.join(bad, live["url"] == bad["feed_url"], "inner").select(
        "idx", F.concat(F.lit("rss_feed_failed:"), F.col("url"), F.lit(": "),
                        F.substring(F.lit("malformed XML"), 1, 200)).alias("warning"))
    return missing.unionByName(failed)


def repo_stars(pages: DataFrame, limit: int = 30) -> DataFrame:
    """``pages(page_no, json)`` of starred repos -> sources in page order,
    rows without ``html_url`` skipped, first ``limit`` kept (a top-k)."""
    rows = pages.select("page_no", F.posexplode(F.from_json("json", REPOS_SCHEMA)).alias("pos", "r"))
    rows = rows.filter(F.col("r.html_url").isNotNull() & (F.col("r.html_url") != ""))
    top = rows.orderBy("page_no", "pos").limit(max(limit, 0))
    topics = F.coalesce(F.col("r.topics"), F.array().cast("array<string>"))
    body = F.concat_ws("\n",
                       F.when(F.coalesce(F.col("r.description"), F.lit("")) != "", F.col("r.description")),
                       F.when(F.size(topics) > 0, F.concat(F.lit("Topics: "), F.array_join(topics, ", "))),
                       F.when(F.coalesce(F.col("r.language"), F.lit("")) != "",
                              F.concat(F.lit("Language: "), F.col("r.language"))))
    title = F.coalesce(F.when(F.col("r.full_name") != "", F.col("r.full_name")),
                       F.when(F.col("r.name") != "", F.col("r.name")), F.col("r.html_url"))
    return top.select(
        "page_no", "pos", F.col("r.html_url").alias("url"), canonical_url(F.col("r.html_url")).alias("canonical_url"),
        title.alias("title"), body.alias("body"), F.lit("github_starred_repo").alias("source_type"),
        F.lit("github_starred").alias("method"), F.array().cast("array<string>").alias("errors"),
        F.create_map(F.lit("stars"), F.coalesce(F.col("r.stargazers_count").cast("string"), F.lit("")))
        .alias("metadata"))
