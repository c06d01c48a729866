"""Job queue and fetch-attempt logs: latest job state and the queue's flow
(T3, batch form), probe verdict roll-up (A10) and errors by origin (A11).

Logs are append-only; the current state is a per-key ``max_by`` over the
log (partial aggregation before the shuffle, so a hot job id costs one row
per map task), never an in-place update.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curation.functions.quality import metadata_verdict, transcript_verdict
from curation.functions.text import utf16_length

# The hand-off item of a job that the worker finished.
DONE_TITLE = "YouTube (本地转录)"
DONE_METHOD = "mac_local_whisper"
DONE_LANGUAGE = "zh+en"
DONE_FAILED = "mac_failed"


def job_states(log: DataFrame) -> DataFrame:
    """``log(job_id, event_id, ts, status)`` -> latest status per job with
    first enqueue time, last claim time and event count."""
    order = F.struct("ts", "event_id")
    return log.groupBy("job_id").agg(
        F.max_by("status", order).alias("status"),
        F.min(F.when(F.col("status") == "pending", F.col("ts"))).alias("created_at"),
        F.max(F.when(F.col("status") == "processing", F.col("ts"))).alias("picked_at"),
        F.count("*").alias("n_events"),
    )


def first_at_or_after(rows: DataFrame, at: str, marks: DataFrame, mark: str, name: str) -> DataFrame:
    """``rows`` with ``name``: the first time of ``marks`` that is not before
    the row's ``at`` (NULL if there is none).

    An as-of join by hours: inside an hour a running minimum from its end, and
    beyond it the first mark of the next hour that has one.  The hours are one
    row each, so their single-task window is bounded by the calendar.
    """
    m = marks.select(F.col(mark).alias("_m")).filter(F.col("_m").isNotNull()).distinct()
    hour = F.date_trunc("hour", "_t")
    both = rows.withColumn("_t", F.col(at)).withColumn("_m", F.lit(None).cast(dict(m.dtypes)["_m"])).unionByName(
        m.withColumn("_t", F.col("_m")), allowMissingColumns=True).withColumn("_hour", hour)
    # a mark at the very time of a row stands before it in this order
    here = Window.partitionBy("_hour").orderBy(F.col("_t").desc(), F.col("_m").desc_nulls_last())
    near = both.withColumn("_near", F.min("_m").over(here.rowsBetween(Window.unboundedPreceding, 0)))
    hours = both.groupBy("_hour").agg(F.min("_m").alias("_first"))
    later = Window.orderBy(F.col("_hour").desc()).rowsBetween(Window.unboundedPreceding, -1)
    hours = hours.filter(F.col("_hour").isNotNull()).withColumn("_next", F.min("_first").over(later))
    out = near.filter(F.col("_m").isNull()).join(hours.select("_hour", "_next"), "_hour", "left")
    found = F.when(F.col("_t").isNotNull(), F.coalesce("_near", "_next"))
    return out.select(*rows.columns, found.alias(name))


def job_flow(jobs: DataFrame, polls: DataFrame, done: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(queue, outcomes)`` of a job queue after its whole log.

    ``jobs(job_id, url, run_id, created_at)`` are enqueued as pending (ids are
    unique).  A poll (``polls(ts)``) claims every pending job: the first poll
    that is not before its enqueueing is its ``picked_at``.  A report
    (``done(job_id, ts, ok, url, run_id, raw_text, chars, language, error)``)
    removes its job if that is in the queue by then; a good one emits the
    hand-off item, a failed one its reason.  ``queue`` holds the jobs left.
    """
    removed = (jobs.select("job_id", "created_at").join(done.select("job_id", "ts"), "job_id")
               .filter("ts >= created_at").select("job_id").distinct())
    left = first_at_or_after(jobs.join(removed, "job_id", "left_anti"), "created_at", polls, "ts", "picked_at")
    queue = left.select("job_id", "url", "run_id",
                        F.when(F.col("picked_at").isNull(), "pending").otherwise("processing").alias("status"),
                        "created_at", "picked_at")
    return queue, reported(done)


def reported(done: DataFrame) -> DataFrame:
    """The hand-off item or the failure reason of every report."""
    ok = F.coalesce("ok", F.lit(False))

    def item(col):
        return F.when(ok, col)

    def given(col, default):
        return F.coalesce(F.when(F.col(col) != "", F.col(col)), F.lit(default))
    n = F.coalesce(F.when(F.col("chars") != 0, F.col("chars")), utf16_length(F.col("raw_text")))
    return done.select(
        "job_id", "run_id", ok.alias("forwarded"), F.when(~ok, given("error", DONE_FAILED)).alias("reason"),
        item(F.lit("youtube")).alias("source_type"), item(F.col("url")).alias("source_url"),
        item(F.lit(DONE_TITLE)).alias("title"), item(F.col("raw_text")).alias("transcript"),
        item(given("language", DONE_LANGUAGE)).alias("language"), item(n).alias("chars"),
        item(F.lit(DONE_METHOD)).alias("method"))


def probe_verdicts(log: DataFrame) -> DataFrame:
    """One verdict per attempt; ``log(label, probe, ok, error)``."""
    out = F.when(F.col("ok"), F.lit("title|||0")).otherwise(F.col("error"))
    v = F.when(F.col("probe") == "transcript", transcript_verdict(F.col("error"))) \
        .otherwise(metadata_verdict(F.col("ok"), out))
    return log.withColumn("verdict", v)


def probe_rollup(log: DataFrame) -> DataFrame:
    """A10: per exit label, usable > no_captions > blocked > auth_fail > unknown."""
    v = probe_verdicts(log)
    g = v.groupBy("label").agg(
        F.count("*").alias("n_probes"),
        F.bool_or(F.col("verdict") == "PASS").alias("_pass"),
        F.bool_or((F.col("probe") == "transcript") & (F.col("verdict") == "NO_CAPTIONS")).alias("_nc"),
        F.bool_or(F.col("verdict") == "BLOCKED").alias("_bl"),
        F.bool_or(F.col("verdict") == "AUTH_FAIL").alias("_af"),
    )
    final = (F.when(F.col("_pass"), "usable").when(F.col("_nc"), "no_captions").when(F.col("_bl"), "blocked")
             .when(F.col("_af"), "auth_fail").otherwise("unknown"))
    return g.select("label", "n_probes", final.alias("final"))


def fleet_advice(log: DataFrame) -> DataFrame:
    """A10 fleet summary: any exit usable / any exit blocked (one row)."""
    v = probe_verdicts(log)
    return v.agg(F.bool_or(F.col("verdict") == "PASS").alias("any_pass"),
                 F.bool_or(F.col("verdict") == "BLOCKED").alias("any_blocked"))


def errors_by_origin(errors: DataFrame) -> DataFrame:
    """``errors(error)`` grouped by the prefix of the feed that raised it."""
    origin = (F.when(F.col("error").startswith("X API"), "x")
              .when(F.col("error").startswith("YouTube"), "podcasts").otherwise("other"))
    return errors.groupBy(origin.alias("origin")).agg(F.count("*").alias("n_errors"),
                                                      F.count_distinct("error").alias("n_distinct"))
