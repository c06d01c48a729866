"""Registered feed-reader queries.  Every page is rendered in-plan to an
RSS document, an Atom document and a starred-repo JSON page (stand-in
input), which the readers then parse back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curation.functions import html as H
from curation.functions.urls import canonical_url
from curation.plans import sqlgen as S
from curation.plans.registry import register
from curation.session import read_table
from curation.sources import feeds as FE
from curation.sources.feed_reader import read_feeds

PUBLISHED = "Mon, 01 Jan 2024 00:00:00 GMT"


def _esc(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def _host(url):
    return F.lower(F.regexp_extract(url, "://([^/?#]*)", 1))


def feed_documents(spark: SparkSession, sf: str) -> DataFrame:
    """``(feed_id, feed_url, xml, atom, host, url_cfg, limit, priority)`` per page."""
    p = read_table(spark, sf, "pages")
    t = _esc(H.page_title(F.col("html")))
    u = _esc(F.col("url"))
    rss = F.concat(
        F.lit('<rss version="2.0"><channel><title>Feed '), F.col("page_id"), F.lit("</title>"),
        F.lit("<item><title>"), t, F.lit("</title><link>"), u, F.lit("</link><description>Summary of "), t,
        F.lit(f"</description><pubDate>{PUBLISHED}</pubDate></item>"),
        F.lit("<item><guid>"), u, F.lit("</guid><description>&lt;p&gt;copy of item&lt;/p&gt;</description></item>"),
        F.lit("<item><title>tagged</title><guid>tag:example.com,2024:"), F.col("page_id"), F.lit("</guid></item>"))
    host = _host(F.col("url"))
    rss = F.when(host.startswith("m."), rss).otherwise(F.concat(rss, F.lit("</channel></rss>")))
    atom = F.concat(
        F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>Atom '), F.col("page_id"), F.lit("</title>"),
        F.lit("<entry><title>"), t, F.lit('</title><link rel="self" href="'), u, F.lit('/self"/><link href="'), u,
        F.lit('"/><updated>2024-01-30T00:00:00Z</updated><summary>'), t, F.lit("</summary></entry>"),
        F.lit('<entry><title>only related</title><link rel="related" href="https://example.com/rel/'),
        F.col("page_id"), F.lit('"/></entry></feed>'))
    feed_url = F.concat(F.lit("https://feeds.example.com/"), F.col("page_id"))
    cfg_url = F.when(host.startswith("www."), F.lit(None).cast("string")).otherwise(feed_url)
    limit = F.when(F.instr(host, "spam") > 0, 0).when(F.col("url").startswith("http:"), 1).otherwise(2)
    return p.select(F.col("page_id").alias("feed_id"), feed_url.alias("feed_url"), rss.alias("xml"),
                    atom.alias("atom"), host.alias("host"), cfg_url.alias("url_cfg"), limit.alias("limit"),
                    F.lit(1).alias("priority"))


_DOCS_SQL = f"""p AS (
  SELECT page_id AS feed_id, url, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host,
         {S.page_title('html')} AS t, 'Feed ' || page_id AS feed_title
  FROM pages),
cfg AS (
  SELECT *, CASE WHEN starts_with(host, 'www.') THEN NULL ELSE 'https://feeds.example.com/' || feed_id END AS url_cfg,
         CASE WHEN strpos(host, 'spam') > 0 THEN 0 WHEN starts_with(url, 'http:') THEN 1 ELSE 2 END AS lim
  FROM p),
items AS (
  SELECT feed_id, 0 AS pos, {S.strip('url')} AS url, {S.unescape('t')} AS item_title, '{PUBLISHED}' AS published,
         {S.unescape("'Summary of ' || t")} AS "desc", feed_title FROM p WHERE NOT starts_with(host, 'm.')
  UNION ALL
  SELECT feed_id, 1, {S.strip('url')}, '', '', '<p>copy of item</p>', feed_title FROM p WHERE NOT starts_with(host, 'm.')
  UNION ALL
  SELECT feed_id, 2, '', 'tagged', '', '', feed_title FROM p WHERE NOT starts_with(host, 'm.'))"""


@register("rss_items", oracle=f"""WITH {_DOCS_SQL}
SELECT feed_id, pos, url, item_title, published, "desc", feed_title FROM items""")
def rss_items(spark: SparkSession, sf: str) -> DataFrame:
    """RSS items in document order (link, else URL guid; raw fields)."""
    return FE.parse_rss(feed_documents(spark, sf)).select("feed_id", "pos", "url", "item_title", "published",
                                                          "desc", "feed_title")


@register("limit_per_feed", oracle=f"""WITH {_DOCS_SQL},
kept AS (
  SELECT i.*, c.url_cfg FROM items i JOIN cfg c ON i.feed_id = c.feed_id
  WHERE c.url_cfg IS NOT NULL AND c.lim > 0 AND i.url <> '' AND i.pos < (CASE WHEN c.lim = 1 THEN 1 ELSE 2 END))
SELECT feed_id, pos, url, {S.canonical_url('url')} AS canonical_url,
       CASE WHEN item_title <> '' THEN item_title ELSE url END AS title,
       CASE WHEN pos = 0 THEN {S.collapse('"desc"')} || chr(10) || published ELSE 'copy of item' END AS body,
       'feed_fetch' AS method, 1 AS priority, feed_title, CASE WHEN published <> '' THEN published END AS published
FROM kept""")
def limit_per_feed_q(spark: SparkSession, sf: str) -> DataFrame:
    """First ``limit`` valid items per configured feed -> sources."""
    docs = feed_documents(spark, sf)
    live = docs.filter(F.col("url_cfg").isNotNull())
    src = FE.feed_sources(FE.parse_rss(live), live.select("feed_id", "limit", "priority"))
    return src.select("feed_id", "pos", "url", "canonical_url", "title", "body", "method", "priority",
                      F.col("metadata")["feed_title"].alias("feed_title"),
                      F.col("metadata")["published"].alias("published"))


@register("atom_items", oracle=f"""WITH {_DOCS_SQL}
SELECT feed_id, 0 AS pos, {S.strip('url')} AS url, {S.canonical_url(S.strip('url'))} AS canonical_url,
       {S.unescape('t')} AS title, 'Atom ' || feed_id AS feed_title FROM p
UNION ALL
SELECT feed_id, 1, 'https://example.com/rel/' || feed_id, 'https://example.com/rel/' || feed_id, 'only related',
       'Atom ' || feed_id FROM p""")
def atom_items(spark: SparkSession, sf: str) -> DataFrame:
    """S3: Atom entries; alternate link (missing rel counts), else first href."""
    docs = feed_documents(spark, sf).select("feed_id", "feed_url", F.col("atom").alias("xml"))
    a = FE.parse_atom(docs)
    return a.select("feed_id", "pos", "url", canonical_url(F.col("url")).alias("canonical_url"),
                    F.col("item_title").alias("title"), "feed_title")


@register("feed_diagnostics", oracle=f"""WITH {_DOCS_SQL}
SELECT feed_id + 1 AS idx, 'rss_feed_skipped:' || (feed_id + 1) || ': missing url' AS warning FROM cfg WHERE url_cfg IS NULL
UNION ALL
SELECT feed_id + 1, 'rss_feed_failed:' || url_cfg || ': malformed XML' FROM cfg
WHERE url_cfg IS NOT NULL AND lim > 0 AND starts_with(host, 'm.')""")
def feed_diagnostics(spark: SparkSession, sf: str) -> DataFrame:
    """Per-feed warnings (missing URL, unparsable XML); never a failure."""
    docs = feed_documents(spark, sf)
    cfg = docs.select((F.col("feed_id") + 1).alias("idx"), F.col("url_cfg").alias("url"), "limit")
    fetched = docs.filter(F.col("url_cfg").isNotNull()).select("feed_url", "xml")
    return FE.feed_diagnostics(cfg, fetched)


def star_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as starred-repo JSON pages (two repos each; spam hosts lack a URL)."""
    p = read_table(spark, sf, "pages")
    host = _host(F.col("url"))
    lang = F.regexp_extract("url", "/(en|fr|de|es)/", 1)
    r1 = F.struct(F.when(F.instr(host, "spam") > 0, F.lit(None).cast("string")).otherwise(F.col("url")).alias("html_url"),
                  F.concat(F.lit("owner/"), F.col("page_id")).alias("full_name"),
                  F.concat(F.lit("repo"), F.col("page_id")).alias("name"),
                  H.page_title(F.col("html")).alias("description"),
                  F.array(F.concat(F.lit("lang-"), lang), F.lit("web")).alias("topics"),
                  F.when(lang != "", lang).alias("language"),
                  F.length("html").cast("long").alias("stargazers_count"))
    r2 = F.struct(F.concat(F.col("url"), F.lit("/fork")).alias("html_url"),
                  F.lit(None).cast("string").alias("full_name"), F.lit("").alias("name"),
                  F.lit(None).cast("string").alias("description"), F.array().cast("array<string>").alias("topics"),
                  F.lit(None).cast("string").alias("language"), F.lit(None).cast("long").alias("stargazers_count"))
    return p.select(F.col("page_id").alias("page_no"), F.to_json(F.array(r1, r2)).alias("json"))


@register("repo_stars", oracle=f"""WITH p AS (
  SELECT page_id, url, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host, regexp_extract(url, '/(en|fr|de|es)/', 1) AS lang,
         {S.page_title('html')} AS t, length(html) AS n FROM pages),
r AS (
  SELECT page_id AS page_no, 0 AS pos, url, 'owner/' || page_id AS title,
         concat_ws(chr(10), CASE WHEN t <> '' THEN t END, 'Topics: lang-' || lang || ', web',
                   CASE WHEN lang <> '' THEN 'Language: ' || lang END) AS body, CAST(n AS VARCHAR) AS stars
  FROM p WHERE strpos(host, 'spam') = 0
  UNION ALL
  SELECT page_id, 1, url || '/fork', url || '/fork', '', '' FROM p)
SELECT page_no, pos, url, {S.canonical_url('url')} AS canonical_url, title, body, stars
FROM r ORDER BY page_no, pos LIMIT 30""")
def repo_stars_q(spark: SparkSession, sf: str) -> DataFrame:
    """Starred-repo pages -> first 30 sources in page order."""
    s = FE.repo_stars(star_pages(spark, sf), 30)
    return s.select("page_no", "pos", "url", "canonical_url", "title", "body",
                    F.col("metadata")["stars"].alias("stars"))


def mixed_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as feeds of all kinds: RSS with several text children in an order
    of their own, Atom, RSS with items at the root, and a broken document
    (``idx, url, limit, priority, feed_url, xml``)."""
    p = read_table(spark, sf, "pages")
    t, u, k = _esc(H.page_title(F.col("html"))), _esc(F.col("url")), F.col("page_id") % 5
    rss = F.concat(
        F.lit('<rss xmlns:c="urn:c" xmlns="urn:d"><channel><item><link/><title>no url</title></item><item><title>'), t,
        F.lit("</title><link> "), u, F.lit(" </link><summary> </summary><c:encoded>&lt;p&gt;first &amp;amp; "), F.col("page_id"),
        F.lit("&lt;/p&gt;&lt;p&gt;text&lt;/p&gt;</c:encoded><description>second</description><updated>day  1</updated>"
              "<pubDate>day 2</pubDate></item><item><guid>http://g.example/"), F.col("page_id"),
        F.lit("</guid><DESCRIPTION>plain\n  words</DESCRIPTION></item></channel></rss>"))
    atom = F.concat(
        F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><link href="http://self.example/"/><title>Atom '), F.col("page_id"),
        F.lit('</title><entry><link rel="SELF" href="http://s.example/"/><link rel="Alternate" href=" '), u,
        F.lit(' "/><content>a &lt; b</content><summary>later</summary></entry><entry><title>'), t,
        F.lit('</title><link rel="related" href="http://r.example/'), F.col("page_id"), F.lit('"/></entry></feed>'))
    flat = F.concat(F.lit("<RDF><channel><title> RDF </title></channel><!-- no --><item><title>"), t, F.lit("</title><link>"), u,
                    F.lit("</link></item></RDF>"))
    broken = F.concat(F.lit("<rss><channel><item></channel></rss>"), t)
    xml = F.when(k < 2, rss).when(k == 2, atom).when(k == 3, flat).otherwise(broken)
    return p.select((F.col("page_id") + 1).alias("idx"),
                    F.when(F.col("page_id") % 7 != 0, F.concat(F.lit("https://feeds.example.com/"), F.col("page_id"))).alias("url"),
                    F.when(F.col("page_id") % 3 == 0, 1).when(F.col("page_id") % 11 == 0, 0).alias("limit"), F.lit(2).alias("priority"),
                    F.concat(F.lit("https://feeds.example.com/"), F.col("page_id")).alias("feed_url"), xml.alias("xml"))


@register("mixed_feeds", oracle=f"""WITH p AS (
  SELECT page_id, page_id + 1 AS idx, 'https://feeds.example.com/' || page_id AS feed_url, page_id % 5 AS k, {S.strip('url')} AS u,
         {S.strip(S.unescape(S.page_title('html')))} AS t,
         CASE WHEN page_id % 3 = 0 THEN 1 WHEN page_id % 11 = 0 THEN 0 ELSE 20 END AS lim FROM pages),
live AS (SELECT * FROM p WHERE page_id % 7 <> 0 AND lim > 0),
items AS (
  SELECT idx, feed_url, lim, 0 AS pos, u AS url, CASE WHEN t <> '' THEN t ELSE u END AS title,
         'first & ' || page_id || chr(10) || 'text' || chr(10) || 'day 1' AS body, 'day  1' AS published, '' AS feed_title FROM live WHERE k < 2
  UNION ALL SELECT idx, feed_url, lim, 1, 'http://g.example/' || page_id, 'http://g.example/' || page_id, 'plain words', '', '' FROM live WHERE k < 2
  UNION ALL SELECT idx, feed_url, lim, 0, u, u, 'a < b', '', 'Atom ' || page_id FROM live WHERE k = 2
  UNION ALL SELECT idx, feed_url, lim, 1, 'http://r.example/' || page_id, CASE WHEN t <> '' THEN t ELSE 'http://r.example/' || page_id END, '', '',
         'Atom ' || page_id FROM live WHERE k = 2
  UNION ALL SELECT idx, feed_url, lim, 0, u, CASE WHEN t <> '' THEN t ELSE u END, '', '', 'RDF' FROM live WHERE k = 3)
SELECT idx, feed_url, CAST(pos AS INTEGER) AS pos, url, {S.canonical_url('url')} AS canonical_url, title, body, published, feed_title,
       CAST(NULL AS VARCHAR) AS warning FROM items WHERE pos < lim
UNION ALL
SELECT idx, feed_url, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'rss_feed_failed:' || feed_url || ': mismatched tag: line 1, column 22' FROM live WHERE k = 4
UNION ALL
SELECT idx, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'rss_feed_skipped:' || idx || ': missing url' FROM p WHERE page_id % 7 = 0""")
def mixed_feeds(spark: SparkSession, sf: str) -> DataFrame:
    """RSS, Atom and broken documents in one read: items in document
    order up to each feed's limit, and warnings with the parser's reason."""
    d = mixed_documents(spark, sf)
    return read_feeds(d.select("idx", "url", "limit", "priority"), d.select("feed_url", "xml")).select(
        "idx", "feed_url", "pos", "url", "canonical_url", "title", "body", "published", "feed_title", "warning")
