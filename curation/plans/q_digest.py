"""Registered digest-run queries: union dedupe, budget summary, run report,
state manifest, lifecycle, latest state over two runs, digest lines and
their parse-back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curation.functions.scoring import lifecycle_status, score_sources
from curation.operators.budget import select_for_budget
from curation.operators.dedupe import dedupe_best as dedupe_op
from curation.operators.topk import top_digest
from curation.plans import digest as D
from curation.plans import sqlgen as S
from curation.plans.harvest import arrival, collect_sources, run_digest, run_selection
from curation.plans.q_docs import _REC_SQL, _excerpt_sql, doc_sources
from curation.plans.q_feeds import _DOCS_SQL as FEED_SQL
from curation.plans.q_feeds import feed_documents, star_pages
from curation.plans.q_pages import BUDGET, PER_SOURCE, PRIORITY_DOMAINS, page_sources, pages_sql, selection_sql
from curation.plans.registry import ORACLES, register
from curation.session import ensure_checkpoint_dir, materialize, read_table
from curation.sources import feeds as FE
from curation.sources.pages import ingest_pages

RUN_ID = "run-1"
SEEN_AT = "2024-01-31 00:00:00"


def _run(spark: SparkSession, sf: str) -> DataFrame:
    return run_selection(page_sources(spark, sf), PRIORITY_DOMAINS, BUDGET, PER_SOURCE)


def collected_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Links (landed pages) then feed items, in that arrival order."""
    pages = page_sources(spark, sf).withColumn("priority", F.lit(0)) \
        .withColumn("ordinal", arrival(0, F.lit(0), F.col("ordinal")))
    docs = feed_documents(spark, sf)
    live = docs.filter(F.col("url_cfg").isNotNull())
    feeds = FE.feed_sources(FE.parse_rss(live), live.select("feed_id", "limit", "priority"))
    feeds = feeds.withColumn("ordinal", arrival(2, F.col("feed_id"), F.col("pos")))
    return pages.unionByName(feeds, allowMissingColumns=True)


@register("dedupe_best", oracle=f"""WITH {pages_sql(prefix='pg_')}, {FEED_SQL},
kept AS (
  SELECT i.* FROM items i JOIN cfg c ON i.feed_id = c.feed_id
  WHERE c.url_cfg IS NOT NULL AND c.lim > 0 AND i.url <> '' AND i.pos < (CASE WHEN c.lim = 1 THEN 1 ELSE 2 END)),
u AS (
  SELECT 0 AS family, 0 AS part, ordinal AS pos, canonical_url, title, body, 'fetch' AS method, 0 AS own FROM pg_src
  UNION ALL
  SELECT 2, feed_id, pos, {S.canonical_url('url')},
         CASE WHEN item_title <> '' THEN item_title ELSE url END,
         CASE WHEN pos = 0 THEN {S.collapse('"desc"')} || chr(10) || published ELSE 'copy of item' END,
         'feed_fetch', 1 FROM kept),
sc AS (SELECT *, greatest(own, {S.domain_priority('canonical_url', PRIORITY_DOMAINS)}) AS priority FROM u),
sc2 AS (SELECT *, {S.quality('priority', 'title', 'body', 'method', '0')} AS quality_score FROM sc)
SELECT canonical_url, family, part, pos, method, quality_score FROM (
  SELECT *, row_number() OVER (PARTITION BY canonical_url ORDER BY quality_score DESC, family, part, pos) AS rn FROM sc2)
WHERE rn = 1""")
def dedupe_best(spark: SparkSession, sf: str) -> DataFrame:
    """One source per canonical URL; best score, first arrival on ties."""
    s = score_sources(collected_sources(spark, sf), PRIORITY_DOMAINS)
    best = dedupe_op(s.select("canonical_url", "ordinal", "method", "quality_score"))
    return best.select("canonical_url", "ordinal.*", "method", "quality_score")


@register("collected_run", oracle=f"""WITH {pages_sql(prefix='pg_')}, {FEED_SQL},
kept AS (
  SELECT i.* FROM items i JOIN cfg c ON i.feed_id = c.feed_id
  WHERE c.url_cfg IS NOT NULL AND c.lim > 0 AND i.url <> '' AND i.pos < (CASE WHEN c.lim = 1 THEN 1 ELSE 2 END)),
lk AS (
  SELECT 2 * page_id AS pos, url FROM pages
  UNION ALL SELECT 2 * page_id + 1, CASE WHEN page_id % 3 = 0 THEN 'https://x.com/u/status/' || page_id
    WHEN page_id % 3 = 1 THEN url || '/gone' ELSE url END FROM pages),
ck AS (SELECT pos, {S.canonical_url('url')} AS canonical_url, url LIKE 'https://x.com/%' AS social,
              regexp_extract(url, 'status/([0-9]+)', 1) AS status FROM lk),
land AS (
  SELECT canonical_url, arg_min(body, (p.url, p.html)) AS body, arg_min(title, (p.url, p.html)) AS title
  FROM pg_src s JOIN pages p ON p.page_id = s.ordinal GROUP BY canonical_url)
SELECT 0 AS family, 0 AS part, ck.pos, ck.canonical_url,
       CASE WHEN social THEN 'X/Twitter post ' || status ELSE coalesce(land.title, ck.canonical_url) END AS title,
       CASE WHEN social THEN 'metadata_only' WHEN land.canonical_url IS NULL THEN 'fetch_failed' ELSE 'fetch' END AS method,
       CASE WHEN social OR land.canonical_url IS NULL THEN 1 ELSE 0 END AS n_errors, sha256(coalesce(land.body, '')) AS body_sha256
FROM ck LEFT JOIN land ON ck.canonical_url = land.canonical_url AND NOT ck.social
UNION ALL
SELECT 1, page_no, pos, {S.canonical_url('url')}, title, 'github_starred', 0, sha256(body) FROM (
  SELECT * FROM (
    SELECT page_id AS page_no, 0 AS pos, url, 'owner/' || page_id AS title,
           concat_ws(chr(10), CASE WHEN t <> '' THEN t END, 'Topics: lang-' || lang || ', web',
                     CASE WHEN lang <> '' THEN 'Language: ' || lang END) AS body
    FROM (SELECT page_id, url, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host,
                 regexp_extract(url, '/(en|fr|de|es)/', 1) AS lang, {S.page_title('html')} AS t FROM pages)
    WHERE strpos(host, 'spam') = 0
    UNION ALL SELECT page_id, 1, url || '/fork', url || '/fork', '' FROM pages) ORDER BY page_no, pos LIMIT 30)
UNION ALL
SELECT 2, feed_id, pos, {S.canonical_url('url')}, CASE WHEN item_title <> '' THEN item_title ELSE url END, 'feed_fetch', 0,
       sha256(CASE WHEN pos = 0 THEN {S.collapse('"desc"')} || chr(10) || published ELSE 'copy of item' END) FROM kept""")
def collected_run(spark: SparkSession, sf: str) -> DataFrame:
    """One run over links (every page twice, as a repeat, a social post or
    a link that was not landed), starred repos and feeds; a row per input."""
    p = read_table(spark, sf, "pages")
    again = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://x.com/u/status/"), F.col("page_id"))) \
        .when(F.col("page_id") % 3 == 1, F.concat("url", F.lit("/gone"))).otherwise(F.col("url"))
    links = p.select(F.posexplode(F.array("url", again)).alias("nth", "url"), "page_id") \
        .select((F.col("page_id") * 2 + F.col("nth")).alias("pos"), "url")
    docs = feed_documents(spark, sf)
    live = docs.filter(F.col("url_cfg").isNotNull())
    src = collect_sources(links, p.select("url", "html"),
                          feed_sources=FE.feed_sources(FE.parse_rss(live), live.select("feed_id", "limit", "priority")),
                          star_sources=FE.repo_stars(star_pages(spark, sf), 30))
    return src.select("ordinal.*", "canonical_url", "title", "method", F.size("errors").alias("n_errors"),
                      F.sha2("body", 256).alias("body_sha256"))


@register("budget_summary", oracle=selection_sql() + f"""
SELECT {BUDGET} AS budget, CAST(sum(approx_tokens) AS BIGINT) AS candidate_tokens,
       CAST(sum(selected_tokens) AS BIGINT) AS selected_tokens,
       CAST(greatest(0, {BUDGET} - sum(selected_tokens)) AS BIGINT) AS remaining_tokens,
       count(*) FILTER (WHERE selected) AS selected_sources, count(*) FILTER (WHERE NOT selected) AS skipped_sources
FROM sel""")
def budget_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A2: token budget block of the digest run."""
    return D.budget_summary(_run(spark, sf), BUDGET)


@register("run_report", oracle=selection_sql() + f"""
SELECT true AS ok, '{RUN_ID}' AS run_id, count(*) AS candidate_sources,
       count(*) FILTER (WHERE selected) AS selected_sources, count(*) FILTER (WHERE NOT selected) AS skipped_sources,
       CAST(sum(selected_tokens) AS BIGINT) AS selected_tokens, []::VARCHAR[] AS warnings
FROM sel""")
def run_report(spark: SparkSession, sf: str) -> DataFrame:
    """Run report of the digest run."""
    warnings = spark.createDataFrame([], "idx int, warning string")
    return D.run_report(_run(spark, sf), warnings, RUN_ID)


@register("state_manifest", oracle=selection_sql() + f"""
SELECT substr(sha256(canonical_url), 1, 16) AS id, '{RUN_ID}' AS run_id,
       CASE WHEN selected THEN 'selected' WHEN body <> '' THEN 'extracted' ELSE 'inbox' END AS status,
       canonical_url, title, 'web' AS source_type, 'fetch' AS method, quality_score, approx_tokens, selected_tokens,
       0 AS n_errors, TIMESTAMP '{SEEN_AT}' AS last_seen_at
FROM sel""")
def state_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """One state item per source of the run."""
    m = D.state_manifest(_run(spark, sf), RUN_ID, F.to_timestamp_ntz(F.lit(SEEN_AT)))
    return m.select("id", "run_id", "status", "canonical_url", "title", "source_type", "method", "quality_score",
                    "approx_tokens", "selected_tokens", F.size("errors").alias("n_errors"), "last_seen_at")


def lifecycle_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Document sources with varied methods, errors and empty bodies."""
    s = doc_sources(spark, sf)
    d = read_table(spark, sf, "documents").select(F.col("doc_id").alias("ordinal"), "lang", "n_chars")
    s = s.join(d, "ordinal")
    return s.select(
        "ordinal", "source", "canonical_url", "title", "source_type",
        F.when(F.col("lang") == "de", "metadata_only").when(F.col("lang") == "es", "fetch_failed")
        .otherwise("fetch").alias("method"),
        F.when(F.col("lang") == "es", F.array(F.lit("timeout"))).otherwise(F.array().cast("array<string>"))
        .alias("errors"),
        F.when((F.col("lang") == "fr") & (F.col("n_chars") < 1000), F.lit("")).otherwise(F.col("body")).alias("body"),
        "metadata")


@register("lifecycle", oracle=f"""WITH RECURSIVE {_REC_SQL},
src AS (
  SELECT source, 'doc:' || doc_id AS canonical_url, title,
         CASE WHEN lang = 'fr' AND n_chars < 1000 THEN '' ELSE body END AS body,
         CASE WHEN lang = 'de' THEN 'metadata_only' WHEN lang = 'es' THEN 'fetch_failed' ELSE 'fetch' END AS method,
         CASE WHEN lang = 'es' THEN 1 ELSE 0 END AS nerr, 0 AS priority FROM rec),
sc AS (SELECT *, {S.tokens('title', 'body')} AS approx_tokens,
              {S.quality('priority', 'title', 'body', 'method', 'nerr')} AS quality_score FROM src),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY quality_score DESC, priority DESC, canonical_url) AS rn FROM sc),
{S.budget_walk('ranked', 4000, 900, ['source'])}
SELECT r.canonical_url, r.method, r.quality_score, CASE WHEN w.take THEN w.needed ELSE 0 END AS selected_tokens,
       CASE WHEN r.nerr > 0 OR r.method IN ('metadata_only', 'fetch_failed') THEN 'inbox'
            WHEN w.take THEN 'selected' WHEN r.body <> '' THEN 'extracted' ELSE 'inbox' END AS status
FROM ranked r JOIN walk w ON r.source = w.source AND r.rn = w.rn""")
def lifecycle(spark: SparkSession, sf: str) -> DataFrame:
    """Inbox / selected / extracted per source after a per-source run."""
    s = score_sources(lifecycle_sources(spark, sf), [])
    s = materialize(s.select("source", "canonical_url", "method", "errors", (F.col("body") != "").alias("has_body"),
                             "quality_score", "priority", "approx_tokens"))
    sel = select_for_budget(s, 4000, 900, keys=["source"])
    st = lifecycle_status(F.col("method"), F.col("errors"),
                          F.when(F.col("has_body"), F.lit("x")).otherwise(F.lit("")), F.col("selected"))
    return sel.select("canonical_url", "method", "quality_score", "selected_tokens", st.alias("status"))


_RUN2_DOMAINS = ["example.com"]
_RUN2_WHERE = "starts_with(url, 'https:')"


def _manifests(spark: SparkSession, sf: str) -> DataFrame:
    m1 = D.state_manifest(_run(spark, sf), "run-1", F.to_timestamp_ntz(F.lit("2024-01-30 00:00:00")))
    src2 = page_sources(spark, sf).filter(F.col("url").startswith("https:"))
    m2 = D.state_manifest(run_selection(src2, _RUN2_DOMAINS, 3000, PER_SOURCE), "run-2",
                          F.to_timestamp_ntz(F.lit("2024-01-31 00:00:00")))
    return m1.unionByName(m2)


def _status_sql(prefix: str) -> str:
    return f"CASE WHEN {prefix}selected THEN 'selected' WHEN {prefix}body <> '' THEN 'extracted' ELSE 'inbox' END"


@register("state_latest", oracle="WITH RECURSIVE " + selection_sql(prefix="r1_", recursive=False) + ", "
          + selection_sql(3000, PER_SOURCE, _RUN2_DOMAINS, _RUN2_WHERE, prefix="r2_", recursive=False) + f""",
m AS (
  SELECT substr(sha256(canonical_url), 1, 16) AS id, 'run-1' AS run_id, {_status_sql('')} AS status, selected_tokens,
         quality_score, TIMESTAMP '2024-01-30 00:00:00' AS last_seen_at FROM r1_sel
  UNION ALL
  SELECT substr(sha256(canonical_url), 1, 16), 'run-2', {_status_sql('')}, selected_tokens, quality_score,
         TIMESTAMP '2024-01-31 00:00:00' FROM r2_sel)
SELECT id, run_id, status, selected_tokens, quality_score FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY last_seen_at DESC, run_id DESC) AS rn FROM m) WHERE rn = 1""")
def state_latest(spark: SparkSession, sf: str) -> DataFrame:
    """T4: latest state per source over two runs (the second sees https
    pages only, with other priorities and a 3000-token budget)."""
    latest = D.latest_state(_manifests(spark, sf))
    return latest.select("id", "run_id", "status", "selected_tokens", "quality_score")


@register("state_snapshot")
def state_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """T4 as a snapshot that each run is merged into; without what was
    published (the first run's selected items of score 50 or more)."""
    m = materialize(_manifests(spark, sf))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/snapshot-{uuid.uuid4().hex}"
    for run in ("run-1", "run-2"):
        D.merge_snapshot(spark, path, m.filter(F.col("run_id") == run))
    published = m.filter((F.col("run_id") == "run-1") & (F.col("status") == "selected") & (F.col("quality_score") >= 50))
    return D.unpublished(spark, path, published).select("id", "run_id", "status", "selected_tokens", "quality_score")


ORACLES["state_snapshot"] = ORACLES["state_latest"] + """
  AND id NOT IN (SELECT id FROM m WHERE run_id = 'run-1' AND status = 'selected' AND quality_score >= 50)"""


def _digest(spark: SparkSession, sf: str) -> DataFrame:
    warnings = spark.createDataFrame([], "idx int, warning string")
    raw = read_table(spark, sf, "pages").withColumnRenamed("page_id", "ordinal")
    _sel, lines = run_digest(page_sources(spark, sf), PRIORITY_DOMAINS, warnings, BUDGET, PER_SOURCE,
                             raw=raw, extract=lambda df: ingest_pages(df, keep=["ordinal"]))
    return lines


def _digest_sql() -> str:
    ex = _excerpt_sql("body", "selected_tokens")
    return selection_sql() + f""",
summ AS (SELECT sum(approx_tokens) AS cand, sum(selected_tokens) AS st, count(*) FILTER (WHERE selected) AS ns,
                count(*) FILTER (WHERE NOT selected) AS nk FROM sel),
head AS (SELECT unnest(['# Local Source Digest', '', '## Token Budget', '- Budget: {BUDGET}',
                        '- Candidate approx tokens: ' || cand, '- Selected approx tokens: ' || st,
                        '- Remaining approx tokens: ' || greatest(0, {BUDGET} - st), '- Selected sources: ' || ns,
                        '- Skipped sources: ' || nk, '']) AS line,
                 unnest(range(0, 10)) AS sub FROM summ),
picked AS (SELECT *, row_number() OVER (ORDER BY quality_score DESC, priority DESC, canonical_url) AS rk,
                  {ex} AS ex FROM sel WHERE selected),
items AS (SELECT quality_score, priority, canonical_url,
                 unnest(['### ' || rk || '. ' || (CASE WHEN title <> '' THEN title ELSE canonical_url END),
                         '- URL: ' || canonical_url, '- Type: web', '- Method: fetch', '- State: selected',
                         '- Quality score: ' || quality_score, '- Approx tokens used: ' || selected_tokens, '',
                         CASE WHEN ex <> '' THEN ex ELSE '{D.NO_BODY}' END, '']) AS line,
                 unnest(range(0, 10)) AS sub FROM picked),
lines AS (
  SELECT 0 AS section, 0 AS part, NULL AS grp, NULL AS nq, NULL AS np, NULL AS url, sub, line FROM head
  UNION ALL SELECT 2, 0, NULL, NULL, NULL, NULL, 0, '## Priority Sources'
  UNION ALL SELECT 2, 1, NULL, -quality_score, -priority, canonical_url, sub, line FROM items
  UNION ALL SELECT 3, 0, NULL, NULL, NULL, NULL, 0, '## Skipped Due To Budget' FROM summ WHERE nk > 0
  UNION ALL SELECT 3, 1, NULL, -quality_score, -priority, canonical_url, 0,
                   '- score=' || quality_score || ' tokens=' || approx_tokens || ' ' || canonical_url FROM sel WHERE NOT selected
  UNION ALL SELECT 3, 2, NULL, NULL, NULL, NULL, 0, '' FROM summ WHERE nk > 0
  UNION ALL SELECT 4, 0, NULL, NULL, NULL, NULL, 0, '## Manual Follow-Up'
  UNION ALL SELECT 4, 1, NULL, NULL, NULL, NULL, 0, '- None'
  UNION ALL SELECT 4, 2, NULL, NULL, NULL, NULL, 0, '')"""


@register("digest_table", oracle=_digest_sql() + """
SELECT section, part, CAST(grp AS INTEGER) AS grp, CAST(nq AS INTEGER) AS nq, CAST(np AS INTEGER) AS np,
       CAST(url AS VARCHAR) AS url, CAST(sub AS INTEGER) AS sub, line FROM lines""")
def digest_table(spark: SparkSession, sf: str) -> DataFrame:
    """K2: the Markdown digest of the run as ordered line rows."""
    return _digest(spark, sf).select(*D.LINE_COLS)


@register("digest_file", oracle=_digest_sql() + """,
doc AS (SELECT string_split(string_agg(line, chr(10) ORDER BY section NULLS FIRST, part NULLS FIRST, grp NULLS FIRST, nq NULLS FIRST,
               np NULLS FIRST, url NULLS FIRST, sub NULLS FIRST), chr(10)) AS parts FROM lines)
SELECT unnest(range(1, len(parts) + 1)) AS no, unnest(parts) AS line FROM doc""")
def digest_file(spark: SparkSession, sf: str) -> DataFrame:
    """K2: the digest written as ordered text files and read back."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/digest-{uuid.uuid4().hex}"
    D.write_digest(_digest(spark, sf), path)
    return D.read_digest(spark, path)


_ITEMS_SQL = """,
parsed AS (
  SELECT rk - 1 AS pos, CASE WHEN title <> '' THEN title ELSE canonical_url END AS title, canonical_url AS url,
         'web' AS type, quality_score AS score,
         substr(regexp_replace(""" + S.strip("regexp_replace(CASE WHEN ex <> '' THEN ex ELSE '" + D.NO_BODY
                                             + "' END, '(?m)^[-#].*$', '', 'g')") + """, '\\n{2,}', chr(10), 'g'), 1, 240) AS body
  FROM picked)"""


@register("digest_items", oracle=_digest_sql() + _ITEMS_SQL.replace("\\\\n", "\\n") + """
SELECT pos, """ + S.strip("title") + """ AS title, url, type, score, body FROM parsed""")
def digest_items(spark: SparkSession, sf: str) -> DataFrame:
    """The selected part of the digest as one document, parsed back
    into items (title, URL, type, score, 240-char body)."""
    doc = D.selected_digest_document(_digest(spark, sf))
    return D.parse_digest(doc)


@register("digest_top", oracle=_digest_sql() + _ITEMS_SQL.replace("\\\\n", "\\n") + """,
top AS (SELECT *, row_number() OVER (ORDER BY score DESC, title, pos) AS rank FROM parsed
        ORDER BY score DESC, title, pos LIMIT 5),
flag AS (SELECT *, (""" + " OR ".join(f"strpos(lower(title || body), '{w}') > 0" for w in
                                    ["obsidian", "wiki", "agent", "context", "codex", "claude"]) + """) AS hit FROM top)
SELECT rank, pos, title, score, hit AND row_number() OVER (PARTITION BY hit ORDER BY rank) <= 3 AS deep,
       substr(""" + S.strip("replace(body, chr(10), ' ')") + """, 1, 160) AS summary FROM flag""")
def digest_top(spark: SparkSession, sf: str) -> DataFrame:
    """S13 + W3: top 5 parsed digest items and the deep-dive subset."""
    items = D.parse_digest(D.selected_digest_document(_digest(spark, sf)))
    t = top_digest(items, 5, 3, order_extra=["pos"])
    return t.select("rank", "pos", "title", "score", "deep", "summary")
