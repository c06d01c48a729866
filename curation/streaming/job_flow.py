"""T3 as a stream: the job queue's whole flow over a table of open jobs.

An event is a job that is enqueued, a poll that claims every pending job, or
a report that removes its job and emits the hand-off item or the reason.
Within a micro-batch events count in order of time (a job before a poll before
a report of the same time); jobs of earlier batches stand before all of them.

A batch is joined with the open jobs that the batch before left: the first
poll that is not before a job claims it (an as-of join), the first report that
is not before it removes it.  So jobs are rows that Spark deals and spills,
however many are open.  Changes and outcomes are written per batch; the queue
is the last change of each job, which the order pending, processing, removed
gives without a clock.

The open jobs stand in two folders in turn: a batch reads the one and replaces
the other, so a batch that is run again finds what it found before.  A stopped
stream goes on where its checkpoint and these folders are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curation.session import materialize, path_exists
from curation.streaming.jobs import first_at_or_after, reported

#: Parts that the open jobs are written in.
SHARDS = 16
EVENT_COLUMNS = ("kind string, ts timestamp_ntz, job_id long, url string, run_id string, ok boolean, raw_text string, "
                 "chars int, language string, error string")
#: Kinds of events in the order in which those of one time are taken.
JOB, POLL, REPORT = "1 job", "2 poll", "3 report"
PENDING, PROCESSING, REMOVED = "1 pending", "2 processing", "3 removed"

_OPEN = ["job_id", "url", "run_id", "created_at", "picked_at"]
_OPEN_DDL = "job_id long, url string, run_id string, created_at timestamp_ntz, picked_at timestamp_ntz"
_CHANGE_DDL = "change string, " + _OPEN_DDL


def queue_events(jobs: DataFrame, polls: DataFrame, done: DataFrame) -> DataFrame:
    """One log of ``jobs``, ``polls`` and ``done`` (columns as ``job_flow``
    takes them), as a stream source is written."""
    log = (jobs.withColumnRenamed("created_at", "ts").withColumn("kind", F.lit(JOB))
           .unionByName(polls.select("ts").withColumn("kind", F.lit(POLL)), allowMissingColumns=True)
           .unionByName(done.withColumn("kind", F.lit(REPORT)), allowMissingColumns=True))
    return log.select(*(F.col(c.split()[0]).cast(c.split()[1]) for c in EVENT_COLUMNS.split(", ")))


def _touched_jobs(events: DataFrame, before: DataFrame | None) -> DataFrame:
    """The open jobs ``before`` a batch and those that it enqueues, with
    ``_new``, ``_poll`` (the poll that claims the job in this batch) and
    ``_removed``."""
    polls, reports = events.filter(F.col("kind") == POLL), events.filter(F.col("kind") == REPORT)
    # of an id that is enqueued twice, the earliest
    jobs = events.filter(F.col("kind") == JOB).groupBy("job_id").agg(
        F.min(F.struct(F.col("ts").isNull(), F.col("ts").alias("created_at"), "url", "run_id")).alias("j")) \
        .select("job_id", "j.url", "j.run_id", "j.created_at")
    if before is not None:
        jobs = jobs.join(before.select("job_id"), "job_id", "left_anti")
    found = first_at_or_after(jobs, "created_at", polls, "ts", "_poll") \
        .withColumn("picked_at", F.lit(None).cast("timestamp_ntz")).withColumn("_new", F.lit(True))
    if before is not None:
        # one value, carried as text: independent of time zones
        first = polls.agg(F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
        found = found.unionByName(before.withColumn("_new", F.lit(False)).withColumn(
            "_poll", F.when(F.col("picked_at").isNull(), F.lit(first).cast("timestamp_ntz"))))
    # a report without a time counts last
    gone = (found.select("job_id", "created_at", "_new").join(reports.select("job_id", "ts"), "job_id")
            .filter(~F.col("_new") | F.col("ts").isNull() | (F.col("ts") >= F.col("created_at")))
            .groupBy("job_id").agg(F.min("ts").alias("_gone"), F.lit(True).alias("_removed")))
    found = found.join(gone, "job_id", "left")
    claimed = F.col("_gone").isNull() | (F.col("_poll") <= F.col("_gone"))
    return found.select(*_OPEN, "_new", F.when(claimed, F.col("_poll")).alias("_poll"),
                        F.col("_removed").isNotNull().alias("_removed"))


def _run_batch(spark: SparkSession, events: DataFrame, batch_id: int, root: str, shards: int) -> None:
    before = spark.read.schema(_OPEN_DDL).parquet(f"{root}/open/{(batch_id - 1) % 2}") if batch_id else None
    jobs = materialize(_touched_jobs(events, before))  # read for the open jobs and for the changes
    picked = F.coalesce("picked_at", "_poll")
    jobs.filter(~F.col("_removed")).withColumn("picked_at", picked).select(*_OPEN).repartition(shards, "job_id") \
        .write.mode("overwrite").parquet(f"{root}/open/{batch_id % 2}")
    made = F.array_compact(F.array(
        F.when(F.col("_new"), F.lit(PENDING)), F.when(F.col("_poll").isNotNull(), F.lit(PROCESSING)),
        F.when(F.col("_removed"), F.lit(REMOVED))))
    changes = jobs.select(F.explode(made).alias("change"), *_OPEN[:-1], picked.alias("picked_at"))
    changes.withColumn("picked_at", F.when(F.col("change") != PENDING, F.col("picked_at"))) \
        .write.mode("overwrite").parquet(f"{root}/changes/batch_id={batch_id}")
    events.filter(F.col("kind") == REPORT).drop("kind").write.mode("overwrite").parquet(f"{root}/outcomes/batch_id={batch_id}")


def run_job_flow_stream(spark: SparkSession, source_dir: str, root: str, files_per_trigger: int = 64,
                        shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """Runs the stream over what has landed since it last ran, and returns
    ``(queue, outcomes)`` as ``job_flow`` does, of all runs so far."""
    stream = (spark.readStream.schema(EVENT_COLUMNS).option("maxFilesPerTrigger", files_per_trigger)
              .option("recursiveFileLookup", "true").parquet(source_dir))

    def handle(batch: DataFrame, batch_id: int) -> None:
        _run_batch(spark, batch, batch_id, root, shards)

    q = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{root}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()

    def written(what: str, columns: str) -> DataFrame:
        if not path_exists(spark, f"{root}/{what}"):  # nothing has landed yet
            return spark.createDataFrame([], columns)
        return spark.read.schema(columns).parquet(f"{root}/{what}")
    last = written("changes", _CHANGE_DDL).groupBy("job_id").agg(
        F.max_by(F.struct("change", "url", "run_id", "created_at", "picked_at"), "change").alias("j"))
    queue = last.filter(F.col("j.change") != REMOVED).select(
        "job_id", "j.url", "j.run_id", F.substring("j.change", 3, 20).alias("status"), "j.created_at", "j.picked_at")
    return queue, reported(written("outcomes", EVENT_COLUMNS.partition(", ")[2]))
