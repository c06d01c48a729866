"""Registered extraction queries: link extraction (S1), meta tags with a
pluggable cleaner (E4/X1/X2), social embeds (E8), the join form of domain
priority (J1) and the message chunk profile (K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curation.functions import html as H
from curation.functions.urls import canonical_url
from curation.operators.chunk import chunk_documents
from curation.operators.joins import domain_priority_join
from curation.plans import sqlgen as S
from curation.plans.registry import register
from curation.session import read_table
from curation.sources.links import URL_RE, ingest_links
from curation.sources.pages import with_page_fields


@register("page_links", oracle=f"""WITH t AS (
  SELECT page_id, 0 AS src_rank, [url] AS found FROM pages
  UNION ALL
  SELECT page_id, 1, regexp_extract_all(html, {S.q(URL_RE)}) FROM pages)
SELECT page_id, src_rank, CAST(i - 1 AS INTEGER) AS pos,
       CASE WHEN src_rank = 0 THEN found[i] ELSE regexp_replace(found[i], '[.,;:!?]+$', '') END AS url
FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM t)""")
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    """Explicit links (the page URL), then links found in the page
    text, in order, duplicates kept."""
    p = read_table(spark, sf, "pages")
    explicit = p.select("page_id", F.array("url").alias("links"))
    texts = p.select("page_id", F.col("html").alias("text"))
    return ingest_links(explicit, texts, key="page_id").select("page_id", "src_rank", "pos", "url")


def meta_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with meta tags spliced into <head> from their own title:
    description (name-first for https, content-first for http) and an
    og:title on English pages (stand-in input)."""
    p = read_table(spark, sf, "pages")
    t = H.page_title(F.col("html"))
    att = F.replace(F.replace(t, F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;"))
    desc = F.when(F.col("url").startswith("https:"),
                  F.concat(F.lit('<meta name="description" content="About '), att, F.lit('">')))\
        .otherwise(F.concat(F.lit('<meta content="About '), att, F.lit('" property="og:description">')))
    og = F.when(F.instr("url", "/en/") > 0, F.concat(F.lit('<meta property="og:title" content="OG '), att,
                                                      F.lit('">'))).otherwise(F.lit(""))
    html = F.concat(F.lit("<!DOCTYPE html><html><head>"), desc, og,
                    F.regexp_replace(F.col("html"), "^<!DOCTYPE html><html[^>]*><head>", ""))
    return p.select("page_id", "url", html.alias("html"))


def article_cleaner(raw):
    """Example pluggable extractor: text of the <article> element only."""
    return H.html_to_text(F.regexp_extract(raw, r"(?s)<article>(.*)</article>", 1))


def _meta_sql() -> str:
    h = "html2"
    art = S.strip(S.html_to_text(f"regexp_extract({h}, '(?s)<article>(.*)</article>', 1)"))
    builtin = S.html_to_text(h)
    text = f"(CASE WHEN length({art}) >= 120 THEN {art} ELSE {builtin} END)"
    desc = S.meta_content(h, ["description", "og:description", "twitter:description"])
    body = (f"(CASE WHEN {desc} <> '' AND strpos(substr({text}, 1, 500), {desc}) = 0 "
            f"THEN {desc} || chr(10) || chr(10) || {text} ELSE {text} END)")
    return f"""WITH m AS (
  SELECT page_id, url, {S.page_title('html')} AS t FROM pages),
m2 AS (
  SELECT page_id, '<!DOCTYPE html><html><head>'
    || (CASE WHEN starts_with(m.url, 'https:') THEN '<meta name="description" content="About ' || replace(replace(t, '&', '&amp;'), '"', '&quot;') || '">'
             ELSE '<meta content="About ' || replace(replace(t, '&', '&amp;'), '"', '&quot;') || '" property="og:description">' END)
    || (CASE WHEN strpos(m.url, '/en/') > 0 THEN '<meta property="og:title" content="OG ' || replace(replace(t, '&', '&amp;'), '"', '&quot;') || '">' ELSE '' END)
    || regexp_replace(p.html, '^<!DOCTYPE html><html[^>]*><head>', '') AS html2
  FROM m JOIN pages p USING (page_id))
SELECT page_id, {S.page_title(h)} AS title, {desc} AS description,
       CASE WHEN length({art}) >= 120 THEN 'custom' ELSE 'html_to_text' END AS cleaner,
       length({body}) AS body_chars, substr({body}, 1, 200) AS body_head
FROM m2"""


@register("page_meta", oracle=_meta_sql())
def page_meta(spark: SparkSession, sf: str) -> DataFrame:
    """Meta lookups in order, title preference, description
    prefix and a pluggable cleaner with provenance."""
    f = with_page_fields(meta_pages(spark, sf), "html", "f", cleaner=article_cleaner)
    return f.select("page_id", "f.title", "f.description", "f.cleaner", F.length("f.body").alias("body_chars"),
                    F.substring("f.body", 1, 200).alias("body_head"))


def embed_markup(spark: SparkSession, sf: str) -> DataFrame:
    """Pages rendered as social-post embed markup around their title."""
    p = read_table(spark, sf, "pages")
    t = F.replace(F.replace(F.replace(H.page_title(F.col("html")), F.lit("&"), F.lit("&amp;")), F.lit("<"),
                            F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    lang = F.regexp_extract("url", "/(en|fr|de|es)/", 1)
    html = F.concat(F.lit('<blockquote class="twitter-tweet"><p lang="'), lang, F.lit('" dir="ltr">'), t,
                    F.lit(' <a href="https://t.co/x">pic.twitter.com/x</a></p>&mdash; Page '), F.col("page_id"),
                    F.lit(" (@p"), F.col("page_id"), F.lit(') <a href="https://twitter.com/p/status/'),
                    F.col("page_id"), F.lit('">January 1, 2024</a></blockquote>'))
    return p.select("page_id", html.alias("html"))


@register("embed_posts", oracle=f"""WITH e AS (
  SELECT page_id, '<blockquote class="twitter-tweet"><p lang="' || regexp_extract(url, '/(en|fr|de|es)/', 1) || '" dir="ltr">'
    || replace(replace(replace({S.page_title('html')}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')
    || ' <a href="https://t.co/x">pic.twitter.com/x</a></p>&mdash; Page ' || page_id || ' (@p' || page_id
    || ') <a href="https://twitter.com/p/status/' || page_id || '">January 1, 2024</a></blockquote>' AS html FROM pages),
t AS (SELECT page_id, {S.collapse(S.unescape("replace(regexp_replace(html, '<[^<]+?>', ' ', 'g'), '&mdash;', '—')"))} AS text FROM e)
SELECT page_id, text, CASE WHEN length(text) > 70 THEN substr(text, 1, 70) || '...' ELSE text END AS title FROM t""")
def embed_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Embed markup -> text, title = first 70 chars + '...'."""
    e = embed_markup(spark, sf)
    text = H.embed_text(F.col("html"))
    return e.select("page_id", text.alias("text"), H.short_title(text).alias("title"))


def domain_list(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in priority list: parent domains of the page hosts, each placed
    by its first page."""
    p = read_table(spark, sf, "pages")
    host = F.regexp_replace(F.lower(F.regexp_extract("url", "://([^/?#]*)", 1)), r"^www\.", "")
    return (p.groupBy(F.regexp_replace(host, r"^[^.]+\.", "").alias("domain"))
            .agg(F.min("page_id").alias("idx")))


@register("domain_priority", oracle=f"""WITH d AS (
  SELECT domain, min(page_id) AS idx, count(*) OVER () AS n FROM (
    SELECT page_id, regexp_replace(regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), '^www\\.', ''), '^[^.]+\\.', '') AS domain
    FROM pages) GROUP BY domain),
c AS (SELECT page_id, {S.canonical_url('url')} AS canonical_url FROM pages),
h AS (SELECT *, {S.domain('canonical_url')} AS host FROM c)
SELECT h.page_id, h.canonical_url, CAST(coalesce(max(greatest(1, d.n - d.idx)), 0) AS INTEGER) AS priority
FROM h LEFT JOIN d ON h.host = d.domain OR suffix(h.host, '.' || d.domain)
GROUP BY h.page_id, h.canonical_url""")
def domain_priority(spark: SparkSession, sf: str) -> DataFrame:
    """J1 (large list): suffix-expansion equi-join, first listed domain wins."""
    p = read_table(spark, sf, "pages").select("page_id", canonical_url(F.col("url")).alias("canonical_url"))
    return domain_priority_join(p, "canonical_url", domain_list(spark, sf)).select("page_id", "canonical_url",
                                                                                  "priority")


def _message_chunks_sql(size: int = 4000, min_split: int = 2000) -> str:
    # Last newline at index <= size (0-based) inside the remaining text.
    win = f"substr(rest, 1, {size + 1})"
    at = f"(CASE WHEN strpos({win}, chr(10)) > 0 THEN length(regexp_extract({win}, '(?s)^(.*)\n', 1)) ELSE -1 END)"
    return f"""WITH RECURSIVE c(doc_id, part_no, part, rest) AS (
  SELECT doc_id, -1, CAST(NULL AS VARCHAR), text FROM documents WHERE text <> ''
  UNION ALL
  SELECT doc_id, part_no + 1,
         CASE WHEN length(rest) <= {size} THEN rest ELSE substr(rest, 1, split) END,
         CASE WHEN length(rest) <= {size} THEN '' ELSE substr(rest, split + 1) END
  FROM (SELECT *, CASE WHEN {at} < {min_split} THEN {size} ELSE {at} END AS split FROM c WHERE rest <> ''))
SELECT doc_id, part_no, part, length(part) AS part_chars FROM c WHERE part_no >= 0"""


@register("message_chunks", oracle=_message_chunks_sql())
def message_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """K5 message profile: 4000 UTF-16 units, newline cut (not before 2000),
    nothing stripped; parts re-join to the whole text."""
    d = read_table(spark, sf, "documents")
    return chunk_documents(d, "text", ["doc_id"], profile="message")
