"""Registered streaming queries: events are landed by day in one job and
replayed through Structured Streaming (``availableNow``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curation.operators.feeds import ingest_posts
from curation.plans.q_events import posts_from_events
from curation.plans.q_flows import queue_log
from curation.plans.registry import ORACLES, register
from curation.session import read_table
from curation.streaming.incremental import (land_by_day, run_first_delivery, run_incremental_feed,
                                            run_job_state_stream, scratch_root)
from curation.streaming.job_flow import queue_events, run_job_flow_stream

FEED_POST_COLUMNS = ("account string, id string, created_at timestamp_ntz, type string, text string, url string, "
                     "likes int, retweets int, replies int, is_quote boolean, quoted_id string")
JOB_LOG_COLUMNS = "job_id bigint, event_id bigint, ts timestamp_ntz, status string"


# One feed run per landed day as a recursive CTE: the state is the list of
# picked ids with their run clock; each step selects the next day's run.
_INCREMENTAL_SQL = """WITH RECURSIVE p AS (
  SELECT 'u' || user_id AS account, CAST(event_id AS VARCHAR) AS id, ts AS created_at,
         CASE WHEN event_type = 'error' THEN 'reply' ELSE 'post' END AS type FROM events),
d AS (SELECT day, row_number() OVER (ORDER BY day) AS k, as_of FROM (
        SELECT CAST(created_at AS DATE) AS day, max(created_at) AS as_of FROM p GROUP BY 1)),
r(k, picked) AS (
  SELECT 0, []::STRUCT(id VARCHAR, account VARCHAR, t TIMESTAMP, k BIGINT, created_at TIMESTAMP)[]
  UNION ALL
  SELECT r.k + 1, list_concat(r.picked, coalesce((
     SELECT list({'id': y.id, 'account': y.account, 't': y.as_of, 'k': r.k + 1, 'created_at': y.created_at})
     FROM (SELECT x.*, row_number() OVER (PARTITION BY x.account ORDER BY x.created_at DESC, x.id DESC) AS rn2
           FROM (SELECT w.*, dd.as_of, row_number() OVER (PARTITION BY w.account ORDER BY w.created_at DESC, w.id DESC) AS rn
                 FROM p w JOIN d dd ON dd.k = r.k + 1
                 WHERE CAST(w.created_at AS DATE) <= dd.day AND w.created_at >= dd.as_of - INTERVAL 24 HOUR
                   AND w.type NOT IN ('retweet', 'reply')) x
           WHERE x.rn <= 5 AND NOT list_contains(
               list_transform(list_filter(r.picked, lambda s: s.t >= x.as_of - INTERVAL 7 DAY), lambda s: s.id), x.id)) y
     WHERE y.rn2 <= 3), []))
  FROM r WHERE r.k < (SELECT max(k) FROM d))
SELECT s.k - 1 AS batch_id, s.t AS run_at, s.account, s.id, s.created_at
FROM (SELECT unnest(picked) AS s FROM r WHERE k = (SELECT max(k) FROM d))"""


@register("incremental_feed", oracle=_INCREMENTAL_SQL)
def incremental_feed(spark: SparkSession, sf: str) -> DataFrame:
    """One feed run per landed day; seen-state with 7-day prune;
    unselected posts stay eligible.  Result: every post picked by any run."""
    root = scratch_root(spark, "feed")
    posts = ingest_posts(posts_from_events(read_table(spark, sf, "events")))
    land_by_day(posts, f"{root}/source", day_col="created_at")
    sink = run_incremental_feed(spark, f"{root}/source", FEED_POST_COLUMNS, root)
    return spark.read.parquet(sink).select(F.col("run").cast("long").alias("batch_id"), "run_at", "account", "id", "created_at")


@register("job_stream")
def job_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Job states from the replayed job log via a streaming aggregation;
    equals the batch job_lifecycle result."""
    ev = read_table(spark, sf, "events")
    log = ev.select(F.col("user_id").alias("job_id"), "event_id", "ts",
                    F.when(F.col("event_type").isin("signup", "view"), "pending")
                    .when(F.col("event_type") == "click", "processing")
                    .when(F.col("event_type") == "purchase", "done")
                    .otherwise("failed").alias("status"))
    root = scratch_root(spark, "jobs")
    land_by_day(log, f"{root}/source", day_col="ts")
    st = run_job_state_stream(spark, f"{root}/source", JOB_LOG_COLUMNS, root)
    return st.select("job_id", "status", "created_at", "picked_at", "n_events")


def _flow_runs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The queue's log up to 15 January, then the rest: the stream is stopped
    between and goes on from its checkpoint."""
    root = scratch_root(spark, "flow")
    log = queue_events(*queue_log(spark, sf))
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    log.filter(early).write.parquet(f"{root}/source/part=1")
    run_job_flow_stream(spark, f"{root}/source", root)
    log.filter(~early).write.parquet(f"{root}/source/part=2")
    return run_job_flow_stream(spark, f"{root}/source", root)


@register("first_deliveries", oracle="""WITH early AS (SELECT event_id AS id FROM events WHERE ts < TIMESTAMP '2024-01-04')
SELECT id, CAST(2 AS BIGINT) AS n_deliveries FROM early UNION ALL SELECT -1, 1""")
def first_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """T1 as a stream with late data: posts of three days arrive, again a day
    later (a repeat) and twelve days later (beyond the retention: delivered
    again); once the clock stands at 20 January, posts of 5 January are late."""
    root = scratch_root(spark, "deliver")
    ev = read_table(spark, sf, "events")
    early = ev.filter(F.col("ts") < F.lit("2024-01-04").cast("timestamp_ntz")).select(F.col("event_id").alias("id"), "ts")

    def later(days: int) -> DataFrame:
        return early.withColumn("ts", F.col("ts") + F.expr(f"INTERVAL {days} DAYS"))
    clock = spark.range(1).select(F.lit(-1).cast("long").alias("id"), F.lit("2024-01-20").cast("timestamp_ntz").alias("ts"))
    late = ev.filter(F.to_date("ts") == F.lit("2024-01-05")).select((-F.col("event_id") - 2).alias("id"), "ts")
    for part in (early.unionByName(later(1)), clock, later(12).unionByName(late)):
        part.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(f"{root}/source")
        out = run_first_delivery(spark, f"{root}/source", "id long, ts timestamp", root, "id", "ts")
    return out.groupBy("id").agg(F.count("*").alias("n_deliveries"))


@register("job_queue_stream")
def job_queue_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The jobs left in the queue, by the stream with its table of open jobs."""
    return _flow_runs(spark, sf)[0]


@register("job_outcomes_stream")
def job_outcomes_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The item or the reason of every report, by the stream."""
    return _flow_runs(spark, sf)[1]


# The streaming job state must equal the batch job state on the final sink.
import curation.plans.q_events  # noqa: E402,F401  (registers job_lifecycle first)
import curation.plans.q_flows  # noqa: E402,F401  (registers job_queue first)

ORACLES["job_stream"] = ORACLES["job_lifecycle"]
# The streamed flow must equal the batch flow.
ORACLES["job_queue_stream"] = ORACLES["job_queue"]
ORACLES["job_outcomes_stream"] = ORACLES["job_outcomes"]
