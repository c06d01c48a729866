"""Registered queries on collected links and records: platform routing,
media ids, mirrors, social posts, manual text, cache resolution, raw-text
intake, transcripts, combined text, coverage, hand-off, queue split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curation.functions import quality as Q
from curation.functions.html import short_title
from curation.functions.scoring import quality_score
from curation.functions.text import approx_tokens
from curation.functions.urls import canonical_url, post_id, video_id
from curation.operators import records as R
from curation.plans import sqlgen as S
from curation.plans.registry import register
from curation.session import read_table
from curation.sources.pages import resolve_cache

# --------------------------------------------------------------- stand-ins


def platform_links(spark: SparkSession, sf: str) -> DataFrame:
    """Page URLs re-labelled to platform hosts by the page's language path
    and host (stand-in input so every platform rule sees rows)."""
    p = read_table(spark, sf, "pages")
    host = F.lower(F.regexp_extract("url", "://([^/?#]*)", 1))
    lang = F.regexp_extract("url", "/(en|fr|de|es)/", 1)
    pid = F.col("page_id").cast("string")
    link = (F.when(F.instr(host, "spam") > 0, F.concat(F.lit("https://www.xiaohongshu.com/explore/"), pid))
            .when(host.startswith("www."), F.concat(F.lit("https://www.netflix.com/title/"), pid))
            .when(lang == "en", F.concat(F.lit("https://www.youtube.com/watch?feature=share&v=v"), pid, F.lit("&t=1")))
            .when(lang == "fr", F.concat(F.lit("https://x.com/u"), pid, F.lit("/status/"), (F.col("page_id") * 1000 + 7)
                                         .cast("string"), F.lit("?s=20")))
            .when(lang == "de", F.concat(F.lit("https://youtu.be/v"), pid, F.lit("?si=x")))
            .when(lang == "es", F.concat(F.lit("https://mp.weixin.qq.com/s/"), pid))
            .when(host.startswith("m."), F.concat(F.lit("https://www.youtube.com/shorts/s"), pid, F.lit("?feature=x")))
            .otherwise(F.col("url")))
    return p.select("page_id", link.alias("url"))


_LINKS_SQL = """links AS (
  SELECT page_id, CASE
    WHEN strpos(host, 'spam') > 0 THEN 'https://www.xiaohongshu.com/explore/' || page_id
    WHEN starts_with(host, 'www.') THEN 'https://www.netflix.com/title/' || page_id
    WHEN lang = 'en' THEN 'https://www.youtube.com/watch?feature=share&v=v' || page_id || '&t=1'
    WHEN lang = 'fr' THEN 'https://x.com/u' || page_id || '/status/' || (page_id * 1000 + 7) || '?s=20'
    WHEN lang = 'de' THEN 'https://youtu.be/v' || page_id || '?si=x'
    WHEN lang = 'es' THEN 'https://mp.weixin.qq.com/s/' || page_id
    WHEN starts_with(host, 'm.') THEN 'https://www.youtube.com/shorts/s' || page_id || '?feature=x'
    ELSE url END AS url
  FROM (SELECT page_id, url, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host,
               regexp_extract(url, '/(en|fr|de|es)/', 1) AS lang FROM pages))"""


def _host_sql(x: str) -> str:
    return f"lower({S.netloc(x)})"


def _platform_sql(x: str, vocab: str) -> str:
    h = _host_sql(x)

    def has(*n):
        return "(" + " OR ".join(f"strpos({h}, '{s}') > 0" for s in n) + ")"
    rules = {
        "collector": [(has("youtu"), "youtube"), (has("x.com", "twitter.com"), "x")],
        "inject": [(has("youtu"), "youtube"), (has("x.com", "twitter"), "x"), (has("xiaohongshu", "xhslink"), "xhs"),
                   (has("weixin", "wemp"), "wechat")],
        "workflow": [(has("youtu"), "youtube"), (has("x.com", "twitter.com"), "x"),
                     (has("weixin", "wemp.app", "mp.weixin"), "weixin"), (has("xiaohongshu", "xhslink"), "xiaohongshu")],
    }[vocab]
    return "(CASE " + " ".join(f"WHEN {c} THEN '{n}'" for c, n in rules) + " ELSE 'web' END)"


@register("platforms", oracle=f"""WITH {_LINKS_SQL}
SELECT page_id, url, {_platform_sql('url', 'collector')} AS platform, {_platform_sql('url', 'inject')} AS source_type,
       {_platform_sql('url', 'workflow')} AS workflow_platform FROM links""")
def platforms(spark: SparkSession, sf: str) -> DataFrame:
    """E5: platform of every link under the three rule vocabularies."""
    l = platform_links(spark, sf)
    return l.select("page_id", "url", Q.platform(F.col("url")).alias("platform"),
                    Q.platform(F.col("url"), "inject").alias("source_type"),
                    Q.platform(F.col("url"), "workflow").alias("workflow_platform"))


def _video_sql(x: str) -> str:
    q = f"regexp_extract({x}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?[^?#]*\\?([^#]*)', 1)"
    v = (f"list_filter(list_transform(list_filter(string_split({q}, '&'), lambda p: strpos(p, '=') > 0), "
         f"lambda p: struct_pack(k := url_decode(replace(split_part(p, '=', 1), '+', ' ')), "
         f"v := url_decode(replace(substr(p, strpos(p, '=') + 1), '+', ' ')))), lambda s: s.k = 'v' AND s.v <> '')[1].v")
    tail = f"split_part(string_split({x}, 'youtu.be/')[-1], '?', 1)"
    shorts = f"regexp_extract({x}, 'youtube\\.com/shorts/([^?&/]+)', 1)"
    return (f"(CASE WHEN strpos({x}, 'youtu.be/') > 0 THEN {tail} WHEN {v} IS NOT NULL THEN {v} "
            f"WHEN {shorts} <> '' THEN {shorts} END)")


@register("media_ids", oracle=f"""WITH {_LINKS_SQL}
SELECT page_id, url, {_video_sql('url')} AS video_id,
       regexp_extract(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)', 3), '/status(?:es)?/(\\d+)', 1) AS post_id
FROM links""")
def media_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Video id (youtu.be tail, v= value, shorts path) and post id."""
    l = platform_links(spark, sf)
    return l.select("page_id", "url", video_id(F.col("url")).alias("video_id"), post_id(F.col("url")).alias("post_id"))


@register("mirror_urls", oracle=f"""WITH {_LINKS_SQL}
SELECT page_id, replace(url, 'mp.weixin.qq.com', 'wemp.app') AS fetch_url FROM links
WHERE {_platform_sql('url', 'workflow')} = 'weixin'""")
def mirror_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Blocked article host rewritten to its mirror before lookup."""
    l = platform_links(spark, sf).filter(Q.platform(F.col("url"), "workflow") == "weixin")
    return l.select("page_id", Q.rewrite_mirror(F.col("url")).alias("fetch_url"))


def manual_table(spark: SparkSession, sf: str) -> DataFrame:
    """Manual texts keyed by raw link (English docs) or by canonical link
    (other docs); every document is dealt to a page by its id."""
    n_pages = read_table(spark, sf, "pages").count()
    d = read_table(spark, sf, "documents").select("doc_id", "lang", "text")
    l = platform_links(spark, sf)
    j = d.join(l, F.pmod(d["doc_id"], F.lit(n_pages)) == l["page_id"], "inner")
    return j.select(
        F.when(F.col("lang") == "en", F.col("url")).otherwise(canonical_url(F.col("url"))).alias("url"),
        F.col("text"), F.col("doc_id"))


_MANUAL_SQL = f"""man AS (SELECT * FROM (
  SELECT CASE WHEN d.lang = 'en' THEN l.url ELSE {S.canonical_url('l.url')} END AS url, arg_max(coalesce(d.text, ''), d.doc_id) AS text
  FROM documents d JOIN links l ON d.doc_id % (SELECT count(*) FROM pages) = l.page_id GROUP BY 1) WHERE text <> ''),
lm AS (
  SELECT l.page_id, l.url, coalesce(a.text, b.text, '') AS manual_text
  FROM links l LEFT JOIN man a ON l.url = a.url LEFT JOIN man b ON {S.canonical_url('l.url')} = b.url)"""


@register("manual_text", oracle=f"""WITH {_LINKS_SQL}, {_MANUAL_SQL}
SELECT page_id, url, length(manual_text) AS manual_chars, sha256(manual_text) AS manual_sha256 FROM lm""")
def manual_text(spark: SparkSession, sf: str) -> DataFrame:
    """Manual text per link by raw URL, else by canonical URL."""
    j = R.attach_manual_text(platform_links(spark, sf), manual_table(spark, sf), order="doc_id")
    return j.select("page_id", "url", F.length("manual_text").alias("manual_chars"),
                    F.sha2("manual_text", 256).alias("manual_sha256"))


@register("short_posts", oracle=f"""WITH {_LINKS_SQL}, {_MANUAL_SQL},
x AS (SELECT *, {S.canonical_url('url')} AS canonical_url,
             regexp_extract(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)', 3), '/status(?:es)?/(\\d+)', 1) AS pid
      FROM lm),
y AS (SELECT *, CASE WHEN pid <> '' THEN 'X/Twitter post ' || pid ELSE 'X/Twitter link' END AS title,
             {S.strip('manual_text')} AS body,
             CASE WHEN manual_text <> '' THEN 'manual_metadata' ELSE 'metadata_only' END AS method,
             CASE WHEN manual_text <> '' THEN 0 ELSE 1 END AS nerr
      FROM x WHERE {S.domain('canonical_url')} IN ('x.com', 'twitter.com', 'mobile.twitter.com')
                OR suffix({S.domain('canonical_url')}, '.twitter.com'))
SELECT url, canonical_url, title, length(body) AS body_chars, method, nerr > 0 AS needs_manual,
       {S.tokens('title', 'body')} AS approx_tokens, {S.quality('0', 'title', 'body', 'method', 'nerr')} AS quality_score
FROM y""")
def short_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Unfetched social posts with manual text or a fallback error."""
    j = R.attach_manual_text(platform_links(spark, sf), manual_table(spark, sf), order="doc_id")
    s = R.short_post_sources(j)
    return s.select("url", "canonical_url", "title", F.length("body").alias("body_chars"), "method",
                    (F.size("errors") > 0).alias("needs_manual"),
                    approx_tokens(F.col("title"), F.col("body")).alias("approx_tokens"),
                    quality_score(F.lit(0), F.col("title"), F.col("body"), F.col("method"), F.col("errors"))
                    .alias("quality_score"))


@register("cache_resolution", oracle=f"""WITH req AS (
  SELECT DISTINCT {S.canonical_url('url')} AS url FROM pages),
cache AS (SELECT sha256({S.canonical_url('url')}) AS url_hash, 'cached ' || page_id AS title, 'cached body' AS text
          FROM pages WHERE strpos(url, '://blog.') > 0),
fetched AS (SELECT {S.canonical_url('url')} AS url, min(page_id) AS page_id FROM pages GROUP BY 1)
SELECT r.url, sha256(r.url) AS url_hash,
       CASE WHEN c.url_hash IS NOT NULL THEN 'cache' ELSE 'fetch' END AS method,
       CASE WHEN c.url_hash IS NOT NULL THEN c.title END AS cached_title
FROM req r LEFT JOIN (SELECT DISTINCT url_hash, title FROM cache) c ON sha256(r.url) = c.url_hash""")
def cache_resolution(spark: SparkSession, sf: str) -> DataFrame:
    """Requests served from the fetch cache (left join on the URL
    hash) or fetched (anti join) with their cache rows."""
    p = read_table(spark, sf, "pages")
    can = canonical_url(F.col("url"))
    req = p.select(can.alias("url")).distinct()
    cache = (p.filter(F.instr("url", "://blog.") > 0)
             .select(F.sha2(can, 256).alias("url_hash"), F.concat(F.lit("cached "), F.col("page_id")).alias("title"),
                     F.lit("cached body").alias("text")).dropDuplicates(["url_hash", "title"]))
    fetched = p.select(can.alias("url"), "html").dropDuplicates(["url"])
    resolved, _update = resolve_cache(req, cache, fetched)
    return resolved.select("url", "url_hash", "method",
                           F.when(F.col("method") == "cache", F.col("title")).alias("cached_title"))


def intake_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as raw-text requests; the link is the page of the same id
    (documents without a page send no links)."""
    d = read_table(spark, sf, "documents").select("doc_id", "text", "lang")
    l = platform_links(spark, sf)
    j = d.join(l, d["doc_id"] == l["page_id"], "left")
    return j.select(F.col("doc_id").alias("request_id"),
                    F.when(F.col("url").isNull(), F.array().cast("array<string>")).otherwise(F.array("url"))
                    .alias("links"),
                    F.col("text").alias("raw_text"),
                    F.when(F.col("lang") == "en", F.lit("")).otherwise(F.col("lang")).alias("language"))


@register("raw_text_intake", oracle=f"""WITH {_LINKS_SQL}
SELECT d.doc_id AS request_id, {_platform_sql('l.url', 'inject')} AS source_type, l.url AS source_url,
       {_platform_sql('l.url', 'inject')} || ' (本地转录注入)' AS title,
       CASE WHEN d.lang = 'en' THEN 'zh+en' ELSE d.lang END AS language,
       CAST(length(d.text) + length(regexp_replace(d.text, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')) AS INTEGER) AS chars,
       'manual_inject' AS method, sha256(d.text) AS transcript_sha256, CASE WHEN length(d.text) + length(regexp_replace(d.text, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')) < 300 THEN '正文不足300字' END AS need_material
FROM documents d JOIN links l ON d.doc_id = l.page_id""")
def raw_text_intake(spark: SparkSession, sf: str) -> DataFrame:
    """Inline text bypass; requests without links are rejected."""
    items, _rejected = R.raw_text_intake(intake_requests(spark, sf))
    return items.select("request_id", "source_type", "source_url", "title", "language", "chars", "method",
                        F.sha2("transcript", 256).alias("transcript_sha256"), "need_material")


@register("raw_text_rejected", oracle=f"""WITH {_LINKS_SQL}
SELECT d.doc_id AS request_id, 'links is required' AS error FROM documents d LEFT JOIN links l ON d.doc_id = l.page_id
WHERE l.page_id IS NULL""")
def raw_text_rejected(spark: SparkSession, sf: str) -> DataFrame:
    """S14 validation: requests without links."""
    _items, rejected = R.raw_text_intake(intake_requests(spark, sf))
    return rejected


@register("split_route", oracle=f"""WITH {_LINKS_SQL}
SELECT page_id, url, CASE WHEN strpos(url, 'youtu') > 0 THEN 'queue' ELSE 'process' END AS route,
       CASE WHEN strpos(url, 'youtu') > 0 THEN 'pending' ELSE 'processing' END AS status,
       CASE WHEN strpos(url, 'youtu') > 0 THEN 'queued_for_mac_worker' END AS fail_reason FROM links""")
def split_route(spark: SparkSession, sf: str) -> DataFrame:
    """Video links to the worker queue, others processed in place."""
    return R.split_route(platform_links(spark, sf)).select("page_id", "url", "route", "status", "fail_reason")


# --------------------------------------------------------------- records

def conversation_records(spark: SparkSession, sf: str) -> DataFrame:
    """One record per conversation: its turns assembled into one body (S11),
    the link of the page with the same id (else a short video link)."""
    c = read_table(spark, sf, "conversations")
    t = R.assemble_transcripts(c, key="conv_id", seq="turn", text="text")
    l = platform_links(spark, sf)
    j = t.join(l, t["conv_id"] == l["page_id"], "left")
    url = F.coalesce(F.col("url"), F.concat(F.lit("https://youtu.be/c"), F.col("conv_id")))
    return j.select("conv_id", url.alias("url"), Q.platform(url, "workflow").alias("platform"),
                    short_title(F.col("body")).alias("title"), "body", "n_segments",
                    F.lit("transcript_api").alias("method"))


_CONV_SQL = f"""{_LINKS_SQL},
tr AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS body, count(*) AS n_segments FROM conversations GROUP BY conv_id),
rec AS (SELECT t.conv_id, coalesce(l.url, 'https://youtu.be/c' || t.conv_id) AS url, t.body, t.n_segments,
               CASE WHEN length(t.body) > 70 THEN substr(t.body, 1, 70) || '...' ELSE t.body END AS title
        FROM tr t LEFT JOIN links l ON t.conv_id = l.page_id),
rec2 AS (SELECT *, {_platform_sql('url', 'workflow')} AS platform FROM rec)"""


@register("transcripts", oracle=f"""WITH {_CONV_SQL}
SELECT conv_id, n_segments, length(body) AS chars, body FROM rec2""")
def transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered segments joined by one space per conversation."""
    r = conversation_records(spark, sf)
    return r.select("conv_id", "n_segments", F.length("body").alias("chars"), "body")


@register("handoff_items", oracle=f"""WITH {_CONV_SQL}
SELECT conv_id, CASE WHEN platform = 'xiaohongshu' THEN 'xhs' ELSE platform END AS source_type, url AS source_url,
       title, length({S.strip('body')}) AS chars, 'zh+en' AS language, 'transcript_api' AS method, sha256(body) AS transcript_sha256
FROM rec2 WHERE body <> ''""")
def handoff_items(spark: SparkSession, sf: str) -> DataFrame:
    """K4: records mapped to the hand-off schema (empty transcripts dropped)."""
    r = conversation_records(spark, sf).withColumn("run", F.lit("r")).withColumn("ordinal", F.col("conv_id"))
    h = R.handoff_items(r)
    return h.select(F.col("ordinal").alias("conv_id"), "source_type", "source_url", "title", "chars", "language",
                    "method", F.sha2("transcript", 256).alias("transcript_sha256"))


@register("platform_set", oracle=f"""WITH {_CONV_SQL}
SELECT DISTINCT platform FROM rec2""")
def platform_set(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct platforms among the records."""
    return R.platform_set(conversation_records(spark, sf))


def turn_records(spark: SparkSession, sf: str) -> DataFrame:
    """Turns as the records of one run per conversation (role as platform)."""
    c = read_table(spark, sf, "conversations")
    return c.select(F.col("conv_id").alias("run"), F.col("turn").alias("ordinal"),
                    F.concat(F.lit("conv://"), F.col("conv_id"), F.lit("/"), F.col("turn")).alias("url"),
                    F.col("role").alias("platform"), F.concat(F.lit("turn "), F.col("turn")).alias("title"),
                    F.col("text").alias("body"))


@register("combined_text", oracle=f"""SELECT conv_id AS run,
  string_agg('[' || role || '] turn ' || turn || chr(10) || text, chr(10) || chr(10) ORDER BY turn) AS combined_text
FROM conversations WHERE {S.strip('text')} <> '' GROUP BY conv_id""")
def combined_text(spark: SparkSession, sf: str) -> DataFrame:
    """Per run, the records with text joined in input order."""
    return R.combine_texts(turn_records(spark, sf))


@register("coverage", oracle=f"""SELECT conv_id AS run, count(*) FILTER (WHERE {S.strip('text')} <> '') AS ok_count,
  count(*) AS total_count, bool_or({S.strip('text')} <> '') AS has_content,
  coalesce(to_json(list({{'url': 'conv://' || conv_id || '/' || turn, 'platform': role}} ORDER BY turn)
                   FILTER (WHERE {S.strip('text')} = '')), '[]') AS need_supplement_json
FROM conversations GROUP BY conv_id""")
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Per run ok / total counts, content flag, failed records as JSON."""
    return R.coverage(turn_records(spark, sf))
