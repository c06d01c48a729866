"""Registered queries over ``events`` (posts, videos, job log, fetch log)
plus ``customer`` / ``nation`` / ``region`` as lookup layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curation.functions import quality as Q
from curation.operators import feeds as FD
from curation.operators.topk import oldest_unseen as oldest_unseen_op
from curation.plans.registry import register
from curation.session import AS_OF, read_table
from curation.streaming.jobs import job_states, probe_rollup as probe_rollup_op

AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"


def _as_of():
    return F.to_timestamp_ntz(F.lit(AS_OF))


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events")


# ---------------------------------------------------------------- stand-ins
def posts_from_events(ev: DataFrame) -> DataFrame:
    """Events in the posts schema: user -> account, error events are
    replies, click events quote the previous event id."""
    return ev.select(
        F.concat(F.lit("u"), F.col("user_id")).alias("account"),
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").alias("created_at"),
        F.col("props").alias("text"),
        F.lit(None).cast("string").alias("note_text"),
        F.when(F.col("event_type") == "error", "reply").otherwise("post").alias("type"),
        F.struct(F.col("value").cast("int").alias("like_count"), F.lit(None).cast("int").alias("retweet_count"),
                 F.lit(0).alias("reply_count")).alias("metrics"),
        F.when(F.col("event_type") == "click",
               F.array(F.struct(F.lit("quoted").alias("type"), (F.col("event_id") - 1).cast("string").alias("id"))))
        .alias("referenced"),
    )


def seen_from_events(ev: DataFrame) -> DataFrame:
    """Seen state stand-in: every viewed event id was delivered before."""
    return ev.filter(F.col("event_type") == "view").select(F.col("event_id").cast("string").alias("seen_id"),
                                                           F.col("ts").alias("seen_at"))


_POSTS_SQL = f"""posts AS (
  SELECT 'u' || user_id AS account, CAST(event_id AS VARCHAR) AS id, ts AS created_at, props AS text,
         CASE WHEN event_type = 'error' THEN 'reply' ELSE 'post' END AS type,
         CAST(trunc(value) AS INTEGER) AS likes, event_type, event_id,
         'https://x.com/u' || user_id || '/status/' || event_id AS url,
         event_type = 'click' AS is_quote,
         CASE WHEN event_type = 'click' THEN CAST(event_id - 1 AS VARCHAR) END AS quoted_id
  FROM events),
win AS (SELECT * FROM posts WHERE created_at >= {AS_OF_SQL} - INTERVAL 24 HOUR AND type NOT IN ('retweet', 'reply')),
r1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account ORDER BY created_at DESC, id DESC) AS rn FROM win) WHERE rn <= 5),
unseen AS (SELECT * FROM r1 WHERE id NOT IN (SELECT CAST(event_id AS VARCHAR) FROM events WHERE event_type = 'view')),
sel AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account ORDER BY created_at DESC, id DESC) AS rn2 FROM unseen) WHERE rn2 <= 3)"""


def _selected_posts(spark: SparkSession, sf: str) -> DataFrame:
    ev = _events(spark, sf)
    posts = FD.ingest_posts(posts_from_events(ev))
    return FD.select_new_posts(posts, seen_from_events(ev), _as_of())


@register("post_window", oracle=f"""WITH {_POSTS_SQL}
SELECT account, id, created_at, text, url, likes, 0 AS retweets, 0 AS replies, is_quote, quoted_id FROM sel""")
def post_window(spark: SparkSession, sf: str) -> DataFrame:
    """24 h lookback, no replies, newest 5 per account,
    drop seen, first 3."""
    return _selected_posts(spark, sf).select("account", "id", "created_at", "text", "url", "likes", "retweets",
                                             "replies", "is_quote", "quoted_id")


@register("post_feed", oracle=f"""WITH {_POSTS_SQL}
SELECT account, list(id ORDER BY created_at DESC, id DESC) AS post_ids, count(*) AS n_posts,
       CAST(sum(likes) AS BIGINT) AS likes
FROM sel GROUP BY account""")
def post_feed(spark: SparkSession, sf: str) -> DataFrame:
    """K3: nested per-account feed (accounts without new posts omitted)."""
    sel = _selected_posts(spark, sf)
    g = FD.feed_by_account(sel)
    return g.select("account", F.transform("posts", lambda p: p["id"]).alias("post_ids"),
                    F.col("n_posts").cast("long").alias("n_posts"),
                    F.aggregate("posts", F.lit(0).cast("long"), lambda acc, p: acc + p["likes"]).alias("likes"))


@register("feed_stats", oracle=f"""WITH {_POSTS_SQL}
SELECT count(DISTINCT account) AS x_builders, count(*) AS total_posts FROM sel""")
def feed_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Accounts with new posts and total posts."""
    return FD.feed_stats(_selected_posts(spark, sf))


def videos_from_events(ev: DataFrame) -> DataFrame:
    """Events as channel video lists: user -> channel, newest first."""
    return ev.select(F.concat(F.lit("ch"), F.col("user_id")).alias("channel"),
                     F.col("user_id").alias("channel_order"), (-F.col("event_id")).alias("pos"),
                     F.col("event_id").cast("string").alias("video_id"), F.col("ts").alias("published_at"),
                     F.col("props").alias("title"))


_VIDEOS_SQL = f"""vids AS (
  SELECT 'ch' || user_id AS channel, user_id AS channel_order, -event_id AS pos, CAST(event_id AS VARCHAR) AS video_id,
         ts AS published_at, props AS title FROM events),
first2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY pos) AS rn FROM vids) WHERE rn <= 2),
cand AS (SELECT * FROM first2 WHERE video_id NOT IN (SELECT CAST(event_id AS VARCHAR) FROM events WHERE event_type = 'view')
         AND published_at IS NOT NULL AND published_at >= {AS_OF_SQL} - INTERVAL 72 HOUR),
pick AS (SELECT * FROM cand ORDER BY published_at, channel_order, pos LIMIT 1)"""


@register("oldest_unseen", oracle=f"""WITH {_VIDEOS_SQL}
SELECT channel, video_id, published_at, title FROM pick""")
def oldest_unseen(spark: SparkSession, sf: str) -> DataFrame:
    """Oldest unseen video among the first 2 of each channel, 72 h."""
    ev = _events(spark, sf)
    seen = seen_from_events(ev).withColumnRenamed("seen_id", "video_id")
    pick = oldest_unseen_op(videos_from_events(ev), seen, _as_of(), FD.VIDEO_LOOKBACK_HOURS)
    return pick.select("channel", "video_id", "published_at", "title")


@register("feed_assembly", oracle=f"""WITH {_POSTS_SQL}, {_VIDEOS_SQL}
SELECT (SELECT count(*) FROM pick) AS podcast_episodes, (SELECT count(DISTINCT account) FROM sel) AS x_builders,
       (SELECT count(*) FROM sel) AS total_posts, {AS_OF_SQL} AS feed_generated_at""")
def feed_assembly(spark: SparkSession, sf: str) -> DataFrame:
    """One record combining the post feed and the podcast feed with
    stats (no join: both feeds are tagged, unioned and aggregated once)."""
    ev = _events(spark, sf)
    x = _selected_posts(spark, sf).select(F.lit("x").alias("kind"), "account")
    seen = seen_from_events(ev).withColumnRenamed("seen_id", "video_id")
    pod = oldest_unseen_op(videos_from_events(ev), seen, _as_of(), FD.VIDEO_LOOKBACK_HOURS)
    pod = pod.select(F.lit("podcast").alias("kind"), F.lit(None).cast("string").alias("account"))
    both = x.unionByName(pod)
    return both.agg(F.count_if(F.col("kind") == "podcast").alias("podcast_episodes"),
                    F.count_distinct(F.when(F.col("kind") == "x", F.col("account"))).alias("x_builders"),
                    F.count_if(F.col("kind") == "x").alias("total_posts"),
                    _as_of().alias("feed_generated_at"))


@register("account_lookup", oracle="""WITH acc AS (SELECT DISTINCT 'User' || user_id AS handle FROM events),
users AS (SELECT 'USER' || c_custkey AS username, c_custkey AS user_id, c_name AS name, c_mktsegment AS bio
          FROM customer)
SELECT a.handle, u.user_id, u.name, u.bio,
       CASE WHEN u.user_id IS NULL THEN 'X API: User not found: ' || a.handle END AS error
FROM acc a LEFT JOIN users u ON lower(a.handle) = lower(u.username)""")
def account_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Resolve account handles case-insensitively; report the rest."""
    ev = _events(spark, sf)
    acc = ev.select(F.concat(F.lit("User"), F.col("user_id")).alias("handle")).distinct()
    cust = read_table(spark, sf, "customer")
    users = cust.select(F.concat(F.lit("USER"), F.col("c_custkey")).alias("username"),
                        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"),
                        F.col("c_mktsegment").alias("bio"))
    return FD.resolve_accounts(acc, users).select("handle", "user_id", "name", "bio", "error")


@register("layered_lookup", oracle="""WITH k AS (SELECT n_name AS key, n_nationkey, n_regionkey FROM nation),
v AS (SELECT key,
  CASE WHEN n_regionkey = 0 THEN 0 WHEN n_regionkey IN (1) THEN 1 WHEN n_regionkey IN (2, 3) THEN 2 END AS layer,
  CASE WHEN n_regionkey = 0 THEN (CASE WHEN n_nationkey < 3 THEN '' ELSE 'user:' || key END)
       WHEN n_regionkey IN (1) THEN 'remote:' || key
       WHEN n_regionkey IN (2, 3) THEN 'local:' || key END AS value FROM k)
SELECT key, value, layer, CASE WHEN layer IS NULL THEN 'Could not load: ' || key END AS error FROM v""")
def layered_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """User layer (wins even if empty) > remote (empty falls through)
    > local; keys in no layer are reported."""
    nat = read_table(spark, sf, "nation").select(F.col("n_name").alias("key"), "n_nationkey", "n_regionkey")
    user = nat.filter(F.col("n_regionkey") == 0).select(
        "key", F.when(F.col("n_nationkey") < 3, F.lit("")).otherwise(F.concat(F.lit("user:"), "key")).alias("value"))
    remote = nat.filter(F.col("n_regionkey").isin(0, 1, 2)).select(
        "key", F.when(F.col("n_regionkey") == 2, F.lit("")).otherwise(F.concat(F.lit("remote:"), "key")).alias("value"))
    local = nat.filter(F.col("n_regionkey").isin(0, 1, 2, 3)).select("key", F.concat(F.lit("local:"), "key")
                                                                       .alias("value"))
    return FD.layered_lookup(nat, [(user, True), (remote, False), (local, True)])


def error_records(ev: DataFrame) -> DataFrame:
    """One row for each error and signup event: user and error text."""
    txt = (F.when((F.col("event_type") == "error") & (F.col("value") < 10), "transcript_api_fail: NoTranscriptFound")
           .when(F.col("event_type") == "error", "fetch_fail: HTTP Error 500")
           .when(F.col("value") < 5, "yt-dlp_fail: Sign in to confirm you are not a bot")
           .otherwise("yt-dlp_fail: HTTP Error 403"))
    return ev.filter(F.col("event_type").isin("error", "signup")).select("user_id", txt.alias("error"))


@register("fail_reasons", oracle="""WITH e AS (
  SELECT user_id,
    CASE WHEN event_type = 'error' AND value < 10 THEN 'transcript_api_fail: NoTranscriptFound'
         WHEN event_type = 'error' THEN 'fetch_fail: HTTP Error 500'
         WHEN value < 5 THEN 'yt-dlp_fail: Sign in to confirm you are not a bot'
         ELSE 'yt-dlp_fail: HTTP Error 403' END AS t
  FROM events WHERE event_type IN ('error', 'signup')),
u AS (SELECT DISTINCT user_id FROM events),
g AS (SELECT u.user_id,
        count(e.t) AS n_errors,
        bool_or(strpos(e.t, 'TranscriptsDisabled') > 0 OR strpos(e.t, 'Sign in') > 0 OR strpos(lower(e.t), 'bot') > 0) AS b1,
        bool_or(strpos(e.t, 'transcript_api_fail') > 0) AS b2,
        bool_or(strpos(e.t, 'yt-dlp_fail') > 0) AS b3
      FROM u LEFT JOIN e ON u.user_id = e.user_id GROUP BY u.user_id)
SELECT user_id, CAST(n_errors AS INTEGER) AS n_errors,
  CASE WHEN b1 THEN 'youtube_blocked' WHEN b2 THEN 'transcript_unavailable' WHEN b3 THEN 'download_failed'
       WHEN n_errors > 0 THEN 'fetch_failed' ELSE 'content_empty' END AS fail_reason FROM g""")
def fail_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """Failure reason of every record from its error list."""
    ev = _events(spark, sf)
    errs = error_records(ev).groupBy("user_id").agg(F.count("*").cast("int").alias("n_errors"),
                                                    Q.fail_reason_of(F.col("error")).alias("fail_reason"))
    return ev.select("user_id").distinct().join(errs, "user_id", "left").select(
        "user_id", F.coalesce("n_errors", F.lit(0)).alias("n_errors"),
        F.coalesce("fail_reason", F.lit("content_empty")).alias("fail_reason"))


def fetch_log(ev: DataFrame) -> DataFrame:
    """Events as probe attempts: label per exit, probe kind, ok, error text."""
    err = (F.when(F.col("event_type") == "purchase", "")
           .when(F.col("event_type") == "view", "TranscriptsDisabled for this video")
           .when(F.col("event_type") == "click", "HTTP Error 403: Forbidden")
           .when(F.col("event_type") == "signup", "Sign in to confirm you are not a bot")
           .otherwise("Connection reset by peer"))
    return ev.select(F.concat(F.lit("exit-"), F.col("user_id"), F.lit("-"), F.col("event_type")).alias("label"),
                     F.when(F.col("value") < 50, "transcript").otherwise("metadata").alias("probe"),
                     (F.col("event_type") == "purchase").alias("ok"), err.alias("error"))


_LOG_SQL = """log AS (
  SELECT 'exit-' || user_id || '-' || event_type AS label, CASE WHEN value < 50 THEN 'transcript' ELSE 'metadata' END AS probe,
         event_type = 'purchase' AS ok,
         CASE event_type WHEN 'purchase' THEN '' WHEN 'view' THEN 'TranscriptsDisabled for this video'
              WHEN 'click' THEN 'HTTP Error 403: Forbidden' WHEN 'signup' THEN 'Sign in to confirm you are not a bot'
              ELSE 'Connection reset by peer' END AS error
  FROM events),
v AS (
  SELECT label, probe,
    CASE WHEN probe = 'transcript' THEN
      CASE WHEN error = '' THEN 'PASS'
           WHEN strpos(lower(error), 'sign in') > 0 OR strpos(lower(error), 'confirm') > 0 OR strpos(lower(error), 'bot') > 0 THEN 'BLOCKED'
           WHEN strpos(lower(error), 'transcriptsdisabled') > 0 OR strpos(lower(error), 'notranscript') > 0 THEN 'NO_CAPTIONS'
           WHEN strpos(error, '403') > 0 OR strpos(error, '401') > 0 OR strpos(lower(error), 'auth') > 0 THEN 'AUTH_FAIL'
           ELSE 'ERROR' END
    ELSE
      CASE WHEN ok THEN 'PASS'
           WHEN strpos(lower(error), 'sign in') > 0 OR strpos(lower(error), 'confirm') > 0 OR strpos(lower(error), 'bot') > 0 THEN 'BLOCKED'
           WHEN strpos(lower(error), '403') > 0 OR strpos(lower(error), '401') > 0 THEN 'AUTH_FAIL'
           ELSE 'ERROR' END
    END AS verdict
  FROM log)"""


@register("probe_rollup", oracle=f"""WITH {_LOG_SQL}
SELECT label, count(*) AS n_probes,
  CASE WHEN bool_or(verdict = 'PASS') THEN 'usable'
       WHEN bool_or(probe = 'transcript' AND verdict = 'NO_CAPTIONS') THEN 'no_captions'
       WHEN bool_or(verdict = 'BLOCKED') THEN 'blocked'
       WHEN bool_or(verdict = 'AUTH_FAIL') THEN 'auth_fail'
       ELSE 'unknown' END AS final
FROM v GROUP BY label""")
def probe_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Verdict per attempt, rolled up per exit label."""
    return probe_rollup_op(fetch_log(_events(spark, sf)))


@register("errors_by_origin", oracle="""WITH e AS (
  SELECT CASE WHEN value < 100 THEN 'X API: fetch failed for u' || user_id ELSE 'YouTube: no transcript for ch' || user_id END AS error
  FROM events WHERE event_type = 'error')
SELECT CASE WHEN starts_with(error, 'X API') THEN 'x' WHEN starts_with(error, 'YouTube') THEN 'podcasts' ELSE 'other' END AS origin,
       count(*) AS n_errors, count(DISTINCT error) AS n_distinct
FROM e GROUP BY 1""")
def errors_by_origin(spark: SparkSession, sf: str) -> DataFrame:
    """Error strings grouped by the feed that raised them."""
    from curation.streaming.jobs import errors_by_origin as op
    ev = _events(spark, sf).filter(F.col("event_type") == "error")
    errs = ev.select(F.when(F.col("value") < 100, F.concat(F.lit("X API: fetch failed for u"), F.col("user_id")))
                     .otherwise(F.concat(F.lit("YouTube: no transcript for ch"), F.col("user_id"))).alias("error"))
    return op(errs)


@register("job_lifecycle", oracle="""WITH j AS (
  SELECT user_id AS job_id, event_id, ts,
    CASE event_type WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'pending' WHEN 'click' THEN 'processing'
                    WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'failed' END AS status
  FROM events)
SELECT job_id, arg_max(status, (ts, event_id)) AS status, min(ts) FILTER (WHERE status = 'pending') AS created_at,
       max(ts) FILTER (WHERE status = 'processing') AS picked_at, count(*) AS n_events
FROM j GROUP BY job_id""")
def job_lifecycle(spark: SparkSession, sf: str) -> DataFrame:
    """T3 (batch form): latest state of every job from its event log."""
    ev = _events(spark, sf)
    log = ev.select(F.col("user_id").alias("job_id"), "event_id", "ts",
                    F.when(F.col("event_type").isin("signup", "view"), "pending")
                    .when(F.col("event_type") == "click", "processing")
                    .when(F.col("event_type") == "purchase", "done")
                    .otherwise("failed").alias("status"))
    return job_states(log)


@register("fleet_advice", oracle=f"""WITH {_LOG_SQL}
SELECT bool_or(verdict = 'PASS') AS any_pass, bool_or(verdict = 'BLOCKED') AS any_blocked FROM v""")
def fleet_advice(spark: SparkSession, sf: str) -> DataFrame:
    """A10 fleet summary: is any exit usable, is any exit blocked."""
    from curation.streaming.jobs import fleet_advice as op
    return op(fetch_log(_events(spark, sf)))


# Planned article filter (documented): minimum read count and maximum age.
MIN_READ_COUNT = 100
MAX_AGE_DAYS = 7


@register("article_filters", oracle=f"""SELECT event_id, user_id, ts, CAST(trunc(value * 10) AS BIGINT) AS read_count FROM events
WHERE CAST(trunc(value * 10) AS BIGINT) >= {MIN_READ_COUNT} AND ts >= {AS_OF_SQL} - INTERVAL {MAX_AGE_DAYS} DAY""")
def article_filters(spark: SparkSession, sf: str) -> DataFrame:
    """articles (events, read count = value x 10) with at least 100
    reads and at most 7 days old at the run clock (pushed to the scan)."""
    ev = _events(spark, sf).select("event_id", "user_id", "ts", (F.col("value") * 10).cast("long").alias("read_count"))
    return ev.filter((F.col("read_count") >= MIN_READ_COUNT)
                     & (F.col("ts") >= _as_of() - F.expr(f"INTERVAL {MAX_AGE_DAYS} DAYS")))
