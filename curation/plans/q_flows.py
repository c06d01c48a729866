"""Registered queries of whole flows: the nested post feed with accounts
(K3), the digest input with missing feeds (J9), the job queue (T3), the fetch
cache's texts (S7), collector meta (E4), transcript gates (E14), segments
(E22) and records with content (F3).

The SQL states its patterns and limits itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curation.functions import html as H
from curation.functions import quality as Q
from curation.functions.urls import canonical_url
from curation.operators import feeds as FD
from curation.operators import records as R
from curation.operators.chunk import route_documents
from curation.plans import sqlgen as S
from curation.plans.q_docs import _chunks_sql
from curation.plans.q_events import _POSTS_SQL, _selected_posts
from curation.plans.q_records import turn_records
from curation.plans.registry import register
from curation.session import materialize, read_table
from curation.sources.pages import resolve_cache
from curation.streaming.jobs import job_flow

# ------------------------------------------------------------- K3, A11


def feed_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Followed accounts (handles of all events' users, and an older spelling
    of each that nobody has) resolved against all customers."""
    ids = read_table(spark, sf, "events").select("user_id").distinct()
    acc = ids.select(F.explode(F.array(F.concat(F.lit("u"), F.col("user_id")), F.concat(F.lit("u_"), F.col("user_id")))).alias("handle"))
    users = read_table(spark, sf, "customer").select(
        F.concat(F.lit("U"), F.col("c_custkey")).alias("username"), F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("bio"))
    return FD.resolve_accounts(acc, users)


_ACCOUNTS_SQL = """ids AS (SELECT DISTINCT user_id FROM events),
accts AS (
  SELECT 'u' || user_id AS handle, user_id FROM ids UNION ALL SELECT 'u_' || user_id, NULL FROM ids),
users AS (SELECT c_custkey, c_name, c_mktsegment FROM customer)"""


@register("account_feed", oracle=f"""WITH {_POSTS_SQL}, {_ACCOUNTS_SQL}
SELECT s.account AS handle, any_value(u.c_name) AS name, any_value(u.c_mktsegment) AS bio, count(*) AS n_posts,
       to_json(list({{'id': s.id, 'text': s.text, 'createdAt': strftime(s.created_at, '%Y-%m-%d %H:%M:%S'), 'url': s.url,
                      'likes': s.likes, 'retweets': 0, 'replies': 0, 'isQuote': s.is_quote, 'quotedId': s.quoted_id}}
                    ORDER BY s.created_at DESC, s.id DESC)) AS posts
FROM sel s JOIN accts a ON s.account = a.handle JOIN users u ON a.user_id = u.c_custkey GROUP BY s.account""")
def account_feed(spark: SparkSession, sf: str) -> DataFrame:
    """K3: every account with new posts, its name and bio, and its posts."""
    g = FD.feed_by_account(_selected_posts(spark, sf), feed_accounts(spark, sf))
    post = F.transform("posts", lambda p: F.struct(
        p["id"].alias("id"), p["text"].alias("text"),
        F.date_format(p["created_at"], "yyyy-MM-dd HH:mm:ss").alias("createdAt"), p["url"].alias("url"),
        p["likes"].alias("likes"), p["retweets"].alias("retweets"), p["replies"].alias("replies"),
        p["is_quote"].alias("isQuote"), p["quoted_id"].alias("quotedId")))
    return g.select(F.col("account").alias("handle"), "name", "bio", F.col("n_posts").cast("long").alias("n_posts"),
                    F.to_json(post, {"ignoreNullFields": "false"}).alias("posts"))


@register("feed_errors", oracle=f"""WITH {_ACCOUNTS_SQL}
SELECT a.handle, 'X API: User not found: ' || a.handle AS error FROM accts a
WHERE a.user_id IS NULL OR a.user_id NOT IN (SELECT c_custkey FROM users)""")
def feed_errors(spark: SparkSession, sf: str) -> DataFrame:
    """K3: the feed's error list, a row for each account that was not found."""
    return feed_accounts(spark, sf).filter(F.col("error").isNotNull()).select("handle", "error")


# ------------------------------------------------------------- J9

def digest_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A digest run for every user and day with events; its feeds were
    fetched if the day has a purchase (posts) or a signup (podcasts); clicks
    are accounts with posts, views are episodes."""
    ev = read_table(spark, sf, "events").withColumn(
        "run", F.concat(F.col("user_id"), F.lit("-"), F.date_format("ts", "yyyyMMdd")))
    kind = F.when(F.col("event_type").isin("purchase", "click"), "x").when(F.col("event_type").isin("signup", "view"), "podcasts")
    feeds = ev.filter(F.col("event_type").isin("purchase", "signup")).select("run", kind.alias("kind"), F.col("ts").alias("generated_at"))
    entries = ev.filter(F.col("event_type").isin("click", "view")).select(
        "run", kind.alias("kind"), F.col("event_id").alias("entry_id"),
        F.when(F.col("event_type") == "click", F.col("event_id") % 3 + 1).alias("n_posts"))
    return ev.select("run").distinct(), feeds, entries


_DIGEST_SQL = """ev AS (SELECT user_id || '-' || strftime(ts, '%Y%m%d') AS run, * FROM events),
fx AS (SELECT run, max(ts) AS at FROM ev WHERE event_type = 'purchase' GROUP BY run),
fp AS (SELECT run, max(ts) AS at FROM ev WHERE event_type = 'signup' GROUP BY run),
ents AS (SELECT run, 'x' AS kind, event_id AS entry_id, event_id % 3 + 1 AS n_posts FROM ev JOIN fx USING (run) WHERE event_type = 'click'
       UNION ALL
       SELECT run, 'podcasts', event_id, NULL FROM ev JOIN fp USING (run) WHERE event_type = 'view')"""


@register("digest_headers", oracle=f"""WITH {_DIGEST_SQL}
SELECT r.run, (SELECT count(*) FROM ents e WHERE e.run = r.run AND kind = 'podcasts') AS podcast_episodes,
       (SELECT count(*) FROM ents e WHERE e.run = r.run AND kind = 'x') AS x_builders,
       CAST(coalesce((SELECT sum(n_posts) FROM ents e WHERE e.run = r.run AND kind = 'x'), 0) AS BIGINT) AS total_posts,
       coalesce(fx.at, fp.at) AS feed_generated_at,
       CASE WHEN fx.run IS NULL AND fp.run IS NULL THEN ['Could not fetch tweet feed', 'Could not fetch podcast feed']
            WHEN fx.run IS NULL THEN ['Could not fetch tweet feed'] WHEN fp.run IS NULL THEN ['Could not fetch podcast feed']
            ELSE []::VARCHAR[] END AS errors
FROM (SELECT DISTINCT run FROM ev) r LEFT JOIN fx ON r.run = fx.run LEFT JOIN fp ON r.run = fp.run""")
def digest_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics, feed time and missing-feed errors of every run."""
    return FD.assemble_feeds(*digest_inputs(spark, sf))[0]


@register("digest_entries", oracle=f"""WITH {_DIGEST_SQL} SELECT run, kind, entry_id, n_posts FROM ents""")
def digest_entries(spark: SparkSession, sf: str) -> DataFrame:
    """The entries of the feeds that were fetched."""
    return FD.assemble_feeds(*digest_inputs(spark, sf))[1].select("run", "kind", "entry_id", "n_posts")


# ------------------------------------------------------------- T3

def queue_log(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events as a queue's log: signups and views enqueue a job, clicks are
    polls, purchases and errors report on the job three events before."""
    ev = read_table(spark, sf, "events")
    url, run_id = F.concat(F.lit("https://youtu.be/v"), F.col("user_id")), F.concat(F.lit("run-"), F.to_date("ts"))
    jobs = ev.filter(F.col("event_type").isin("signup", "view")).select(
        F.col("event_id").alias("job_id"), url.alias("url"), run_id.alias("run_id"), F.col("ts").alias("created_at"))
    done = ev.filter(F.col("event_type").isin("purchase", "error")).select(
        (F.col("event_id") - 3).alias("job_id"), "ts", (F.col("event_type") == "purchase").alias("ok"), url.alias("url"),
        run_id.alias("run_id"), F.col("props").alias("raw_text"), F.when(F.col("value") < 10, 0).alias("chars"),
        F.when(F.col("value") < 20, "").otherwise("en").alias("language"),
        F.when(F.col("value") < 5, "").when(F.col("value") < 50, "whisper failed").alias("error"))
    return jobs, ev.filter(F.col("event_type") == "click").select("ts"), done


@register("job_queue", oracle="""WITH j AS (
  SELECT event_id AS job_id, 'https://youtu.be/v' || user_id AS url, 'run-' || CAST(ts AS DATE) AS run_id, ts AS created_at
  FROM events WHERE event_type IN ('signup', 'view')),
p AS (SELECT DISTINCT ts FROM events WHERE event_type = 'click'),
d AS (SELECT event_id - 3 AS job_id, ts FROM events WHERE event_type IN ('purchase', 'error')),
l AS (SELECT * FROM j WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.job_id = j.job_id AND d.ts >= j.created_at))
SELECT job_id, url, run_id, CASE WHEN p.ts IS NULL THEN 'pending' ELSE 'processing' END AS status, created_at, p.ts AS picked_at
FROM l ASOF LEFT JOIN p ON l.created_at <= p.ts""")
def job_queue(spark: SparkSession, sf: str) -> DataFrame:
    """Enqueue, claim of all pending jobs by a poll, removal by a report:
    the jobs left in the queue."""
    return job_flow(*queue_log(spark, sf))[0]


@register("job_outcomes", oracle="""SELECT event_id - 3 AS job_id, 'run-' || CAST(ts AS DATE) AS run_id, ok AS forwarded,
  CASE WHEN ok THEN NULL WHEN value >= 5 AND value < 50 THEN 'whisper failed' ELSE 'mac_failed' END AS reason,
  CASE WHEN ok THEN 'youtube' END AS source_type, CASE WHEN ok THEN 'https://youtu.be/v' || user_id END AS source_url,
  CASE WHEN ok THEN 'YouTube (本地转录)' END AS title, CASE WHEN ok THEN props END AS transcript,
  CASE WHEN ok THEN CASE WHEN value < 20 THEN 'zh+en' ELSE 'en' END END AS language,
  CASE WHEN ok THEN CAST(length(props) AS INTEGER) END AS chars, CASE WHEN ok THEN 'mac_local_whisper' END AS method
FROM (SELECT *, event_type = 'purchase' AS ok FROM events WHERE event_type IN ('purchase', 'error'))""")
def job_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """The item or the failure reason of every report."""
    return job_flow(*queue_log(spark, sf))[1]


# ------------------------------------------------------------- S7

@register("cache_fills", oracle=f"""WITH c AS (SELECT {S.canonical_url('url')} AS url, page_id, html, strpos(url, '://blog.') > 0 AS old FROM pages),
f AS (SELECT url, arg_min(html, page_id) AS html FROM c GROUP BY url HAVING NOT bool_or(old))
SELECT sha256(url) AS url_hash, url, {S.page_title_or_empty('html')} AS title, sha256({S.page_body('html')}) AS text_sha256 FROM f""")
def cache_fills(spark: SparkSession, sf: str) -> DataFrame:
    """The cache rows that misses add, with their extracted texts."""
    p = read_table(spark, sf, "pages").withColumn("can", canonical_url(F.col("url")))
    cache = p.filter(F.instr("url", "://blog.") > 0).select(
        F.sha2("can", 256).alias("url_hash"), F.lit("").alias("title"), F.lit("").alias("text")).distinct()
    fetched = p.groupBy(F.col("can").alias("url")).agg(F.min_by("html", "page_id").alias("html"))
    _resolved, update = resolve_cache(p.select(F.col("can").alias("url")).distinct(), cache, fetched)
    return update.select("url_hash", "url", "title", F.sha2("text", 256).alias("text_sha256"))


@register("cache_refresh", oracle=f"""WITH c AS (SELECT {S.canonical_url('url')} AS url, arg_min(html, page_id) AS html FROM pages GROUP BY 1)
SELECT url, 'fetch' AS method, {S.page_title_or_empty('html')} AS title, sha256({S.page_body('html')}) AS text_sha256,
       sha256({S.page_body('html')}) AS cached_sha256 FROM c""")
def cache_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """S7 with ``refresh``: every request is fetched again though the cache
    holds it, and the cache rows are replaced by what was fetched."""
    p = read_table(spark, sf, "pages").withColumn("can", canonical_url(F.col("url")))
    fetched = p.groupBy(F.col("can").alias("url")).agg(F.min_by("html", "page_id").alias("html"))
    old = fetched.select(F.sha2("url", 256).alias("url_hash"), F.lit("old").alias("title"), F.lit("stale").alias("text"))
    served, update = resolve_cache(fetched.select("url"), old, fetched, refresh=True)
    kept = update.select(F.col("url").alias("_u"), F.sha2("text", 256).alias("cached_sha256"))
    return served.join(kept, F.col("url") == F.col("_u"), "left").select(
        "url", "method", "title", F.sha2("text", 256).alias("text_sha256"), "cached_sha256")


@register("feed_cache_runs", oracle=f"""WITH c AS (SELECT {S.canonical_url('url')} AS url, arg_min(html, page_id) AS html FROM pages GROUP BY 1)
SELECT run, url, CASE WHEN run = 1 THEN 'feed_fetch' ELSE 'feed_cache' END AS method, sha256(html) AS text_sha256
FROM c, (SELECT unnest([1, 2]) AS run)""")
def feed_cache_runs(spark: SparkSession, sf: str) -> DataFrame:
    """S7 in feed mode: a first run fetches and keeps the documents as they
    are, a second one serves them all from the cache that the first wrote."""
    p = read_table(spark, sf, "pages").withColumn("can", canonical_url(F.col("url")))
    fetched = p.groupBy(F.col("can").alias("url")).agg(F.min_by("html", "page_id").alias("html"))
    req = fetched.select("url")
    empty = spark.createDataFrame([], "url_hash string, title string, text string")
    first, update = resolve_cache(req, empty, fetched, feed=True)
    written = materialize(update.select("url_hash", "title", "text"))
    second, _none = resolve_cache(req, written, fetched, feed=True)
    out = first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))
    return out.select("run", "url", "method", F.sha2("text", 256).alias("text_sha256"))


# ------------------------------------------------------------- E4, E14, E22, F3

@register("collector_meta", oracle=f"""WITH t AS (
  SELECT page_id, '<html><head><meta name="description" content="Plain &amp; ' || page_id || '">'
    || CASE WHEN strpos(url, '/en/') > 0 THEN '<META property=''og:description''  content=''OG  ' || page_id || '''>'
            WHEN strpos(url, '/fr/') > 0 THEN '<meta property="og:description" content="">' ELSE '' END
    || regexp_replace(html, '^<!DOCTYPE html><html[^>]*><head>', '') AS h, url FROM pages)
SELECT page_id, {S.title_tag('h')} AS title,
       CASE WHEN strpos(url, '/en/') > 0 THEN 'OG ' || page_id WHEN strpos(url, '/fr/') > 0 THEN ''
            ELSE 'Plain & ' || page_id END AS description FROM t""")
def collector_meta(spark: SparkSession, sf: str) -> DataFrame:
    """E4 of the collector: og:description first, then description; a tag
    that matches wins even if it is empty."""
    p = read_table(spark, sf, "pages")
    pid = F.col("page_id").cast("string")
    og = (F.when(F.instr("url", "/en/") > 0, F.concat(F.lit("<META property='og:description'  content='OG  "), pid, F.lit("'>")))
          .when(F.instr("url", "/fr/") > 0, F.lit('<meta property="og:description" content="">')).otherwise(F.lit("")))
    html = F.concat(F.lit('<html><head><meta name="description" content="Plain &amp; '), pid, F.lit('">'), og,
                    F.regexp_replace("html", "^<!DOCTYPE html><html[^>]*><head>", ""))
    m = H.collector_meta(F.col("html"))
    return p.select("page_id", html.alias("html")).select("page_id", m["title"].alias("title"), m["desc"].alias("description"))


@register("transcript_gates", oracle="""SELECT conv_id, turn, CAST(length(text) AS INTEGER) AS chars, length(text) > 100 AS usable,
  length(text) < 50 AS too_short FROM conversations""")
def transcript_gates(spark: SparkSession, sf: str) -> DataFrame:
    """Transcripts over 100 characters are used, under 50 rejected."""
    c = read_table(spark, sf, "conversations")
    g = Q.transcript_gate(F.col("text"))
    return c.select("conv_id", "turn", g["chars"].alias("chars"), g["usable"].alias("usable"), g["too_short"].alias("too_short"))


@register("length_segments", oracle=f"""SELECT c.doc_id, 'segmented' AS route, c.part_no, c.part
FROM ({_chunks_sql(3000)}) c JOIN documents d ON c.doc_id = d.doc_id WHERE length(d.text) BETWEEN 3000 AND 10000
UNION ALL SELECT doc_id, CASE WHEN length(text) < 3000 THEN 'full' ELSE 'light' END, 0, text FROM documents
WHERE NOT length(text) BETWEEN 3000 AND 10000""")
def length_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of 3000 to 10000 characters in parts of at most 3000."""
    return route_documents(read_table(spark, sf, "documents").select("doc_id", "text"), "text", ["doc_id"])


@register("content_records", oracle=f"""SELECT conv_id AS run, turn AS ordinal, 'conv://' || conv_id || '/' || turn AS url
FROM conversations WHERE {S.strip('text')} <> ''""")
def content_records(spark: SparkSession, sf: str) -> DataFrame:
    """the records whose body is not blank."""
    return R.has_content(turn_records(spark, sf)).select("run", "ordinal", "url")
