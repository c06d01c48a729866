"""Registered queries over ``pages``: canonical URLs, text, titles, scoring,
dedupe and the budget run (the flagship)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curation.functions import html as H
from curation.functions.urls import canonical_url, source_id
from curation.plans import sqlgen as S
from curation.plans.harvest import run_selection
from curation.plans.registry import register
from curation.session import read_table
from curation.sources.pages import ingest_pages

# Priority domains of the test runs (ordered; earlier = higher priority).
PRIORITY_DOMAINS = ["blog.tionsh.example.net", "example.org", "www.ththhe.example.com"]
BUDGET = 4000
PER_SOURCE = 900


def page_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Landed pages as fetched sources, arrival order = page_id."""
    pages = read_table(spark, sf, "pages")
    return ingest_pages(pages, keep=["page_id"]).withColumnRenamed("page_id", "ordinal")


def pages_sql(domains=PRIORITY_DOMAINS, where: str = "", prefix: str = "") -> str:
    """CTEs ``{prefix}src``, ``{prefix}scored2`` and ``{prefix}best`` (deduped)."""
    x = prefix
    cond = f"WHERE {where}" if where else ""
    return f"""{x}pages_src AS (
  SELECT page_id AS ordinal, url, {S.canonical_url('url')} AS canonical_url,
         {S.page_title_or_empty('html')} AS t0, {S.page_body('html')} AS body
  FROM pages {cond}),
{x}src AS (
  SELECT ordinal, url, canonical_url, CASE WHEN t0 <> '' THEN t0 ELSE canonical_url END AS title, body,
         'web' AS source_type, 'fetch' AS method, 0 AS nerrors
  FROM {x}pages_src),
{x}scored AS (
  SELECT *, {S.domain_priority('canonical_url', domains)} AS priority,
         {S.tokens('title', 'body')} AS approx_tokens
  FROM {x}src),
{x}scored2 AS (
  SELECT *, {S.quality('priority', 'title', 'body', 'method', 'nerrors')} AS quality_score FROM {x}scored),
{x}best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY canonical_url ORDER BY quality_score DESC, ordinal) AS rn0
                 FROM {x}scored2) WHERE rn0 = 1)"""


_PAGES_SQL = pages_sql()


def selection_sql(budget: int = BUDGET, per_source: int = PER_SOURCE, domains=PRIORITY_DOMAINS, where: str = "",
                  prefix: str = "", recursive: bool = True) -> str:
    """CTEs ending in ``{prefix}sel``: every deduped page with the walk result."""
    x = prefix
    head = "WITH RECURSIVE " if recursive else ""
    return f"""{head}{pages_sql(domains, where, x)},
{x}ranked AS (SELECT *, row_number() OVER (ORDER BY quality_score DESC, priority DESC, canonical_url) AS rn FROM {x}best),
{S.budget_walk(x + 'ranked', budget, per_source, name=x + 'walk')},
{x}sel AS (
  SELECT r.*, w.take AS selected, CASE WHEN w.take THEN w.needed ELSE 0 END AS selected_tokens
  FROM {x}ranked r JOIN {x}walk w ON r.rn = w.rn)"""


def _selection_sql(budget: int = BUDGET, per_source: int = PER_SOURCE) -> str:
    return selection_sql(budget, per_source)


@register("canonical_urls", oracle=f"SELECT page_id, url, {S.canonical_url('url')} AS canonical_url FROM pages")
def canonical_urls(spark: SparkSession, sf: str) -> DataFrame:
    """E1 over every page URL."""
    return read_table(spark, sf, "pages").select("page_id", "url", canonical_url(F.col("url")).alias("canonical_url"))


@register("page_text", oracle=f"SELECT page_id, {S.html_to_text('html')} AS text FROM pages")
def page_text(spark: SparkSession, sf: str) -> DataFrame:
    """Readable text of every page."""
    return read_table(spark, sf, "pages").select("page_id", H.html_to_text(F.col("html")).alias("text"))


@register("page_title", oracle=f"SELECT page_id, {S.page_title('html')} AS title FROM pages")
def page_title(spark: SparkSession, sf: str) -> DataFrame:
    """og/twitter title meta, else the <title> element."""
    return read_table(spark, sf, "pages").select("page_id", H.page_title(F.col("html")).alias("title"))


@register("page_ingest", oracle=f"""WITH {_PAGES_SQL}
SELECT ordinal AS page_id, canonical_url, title, body, length(body) AS n_chars FROM src""")
def page_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Pages -> (canonical_url, title, body)."""
    return page_sources(spark, sf).select(F.col("ordinal").alias("page_id"), "canonical_url", "title", "body",
                                          F.length("body").alias("n_chars"))


@register("source_ids", oracle=f"""SELECT page_id, {S.canonical_url('url')} AS canonical_url,
  sha256(url) AS cache_key, substr(sha256({S.canonical_url('url')}), 1, 16) AS id FROM pages""")
def source_ids(spark: SparkSession, sf: str) -> DataFrame:
    """sha256 cache key of the URL and 16-hex state id of the canonical URL."""
    p = read_table(spark, sf, "pages")
    c = canonical_url(F.col("url"))
    return p.select("page_id", c.alias("canonical_url"), F.sha2(F.col("url"), 256).alias("cache_key"),
                    source_id(c).alias("id"))


@register("scored_sources", oracle=f"""WITH {_PAGES_SQL}
SELECT ordinal AS page_id, canonical_url, priority, approx_tokens, quality_score FROM scored2""")
def scored_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Priority, tokens and quality of every page source."""
    from curation.functions.scoring import score_sources
    s = score_sources(page_sources(spark, sf), PRIORITY_DOMAINS)
    return s.select(F.col("ordinal").alias("page_id"), "canonical_url", "priority", "approx_tokens",
                    "quality_score")


@register("budget_select", oracle=_selection_sql() + """
SELECT canonical_url, title, quality_score, priority, approx_tokens, selected_tokens, selected,
       CASE WHEN selected THEN 'selected' ELSE 'extracted' END AS status,
       substr(sha256(canonical_url), 1, 16) AS id
FROM sel""")
def budget_select(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: pages -> E1 -> S8 -> J1/E9/E11 -> A1 -> W1 (4000 / 900)."""
    sel = run_selection(page_sources(spark, sf), PRIORITY_DOMAINS, BUDGET, PER_SOURCE)
    return sel.select("canonical_url", "title", "quality_score", "priority", "approx_tokens", "selected_tokens",
                      "selected", "status", "id")
