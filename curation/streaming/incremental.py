"""Structured Streaming jobs.

T1/T2 ``incremental_feed``: every day of a micro-batch's folders is one feed
run.  A batch's posts land in one write of an append-only table; a run selects from
the last 24 hours of landed posts (F1/F2), newest 5 per account, minus ids
picked in the last 7 days (strict ``<`` prune), first 3.  The picks, kept by
run and the day of its clock, are the seen log.  Unselected posts are not
marked seen, so they stay eligible for later runs.  What the runs of a batch
look at is found in one job; only accounts with a post that an earlier run
looked at wait for that run's picks.  Every write is keyed by batch and run
and overwrites its own folder, so a replayed batch is idempotent.

T3 ``job_state_stream``: the job queue's current state is a streaming
aggregation (``max_by`` per job) kept in Spark's state store; each update
is written per batch and the latest row per job is the state.

All folders live under the session's ``spark.checkpoint.dir`` (a shared
folder on a cluster).  Landed posts are partitioned by day so a run reads
only the days inside its lookback; of the picks a run reads only the days
inside the retention.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curation.operators.feeds import (KEEP_PER_ACCOUNT, POST_LOOKBACK_HOURS, SEEN_RETENTION_DAYS,
                                      exclude_types, lookback)
from curation.operators.topk import cap_per_group
from curation.session import ensure_checkpoint_dir, materialize, path_exists
from curation.streaming.jobs import job_states


#: Runs that the number of a batch's run has room for.
RUNS_PER_BATCH = 1_000_000


def scratch_root(spark: SparkSession, name: str) -> str:
    """A fresh folder for one streaming run under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def land_by_day(df: DataFrame, root: str, day_col: str = "ts") -> None:
    """Land a table under one folder a day, in one job."""
    df.withColumn("day", F.to_date(day_col)).write.mode("append").partitionBy("day").parquet(root)


def _newest_first() -> list[Column]:
    return [F.desc("created_at"), F.desc("id")]


def _batch_runs(spark: SparkSession, batch_id: int, landing: str) -> list[tuple[int, str, object, str]]:
    """``(run, folder, day, clock)`` of a landed batch, in order: a run for
    each day of each folder that the batch's files came in."""
    # The run clock is the newest post landed so far, so late posts do not
    # move it back.  It is carried as text and cast back to the column's own
    # type (independent of time zones).
    newest = F.date_format(F.max("created_at"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("clock")
    landed = spark.read.parquet(landing)
    days = landed.filter((F.col("batch_id") == batch_id) & F.col("day").isNotNull()).groupBy("folder", "day").agg(newest) \
        .orderBy("folder", "day").collect()  # one row a day of the batch
    clock = ""
    if batch_id and days:
        first = min(d["day"] for d in days)
        clock = landed.filter((F.col("batch_id") < batch_id) & (F.col("day") >= F.lit(first))).agg(newest).collect()[0][0] or ""
    runs = []
    for k, d in enumerate(days):
        clock = max(clock, d["clock"])
        runs.append((RUNS_PER_BATCH * batch_id + k, d["folder"], d["day"], clock))
    return runs


def _candidates(landed: DataFrame, runs: DataFrame, batch_id: int, fetch_per_account: int) -> DataFrame:
    """The posts that each of a batch's runs looks at (``run, run_at, day,
    place, ...``): newest ``fetch_per_account`` an account of the last 24 hours,
    of what had landed by then.  All runs in one job: clocks never go back, so
    the clock of a run that looks at a post stands on its day or the next."""
    own = landed.filter(F.col("batch_id") == batch_id).join(
        F.broadcast(runs.select("folder", "day", F.col("run").alias("_from"))), ["folder", "day"])
    posts = own
    if batch_id:
        start = F.date_sub(F.to_date(F.lit(runs.agg(F.min("clock")).first()[0])), POST_LOOKBACK_HOURS // 24)
        posts = own.unionByName(landed.filter((F.col("batch_id") < batch_id) & (F.col("day") >= start))
                                .withColumn("_from", F.lit(-1).cast("long")))
    posts = exclude_types(posts).drop("batch_id", "folder", "day") \
        .withColumn("day", F.explode(F.sequence(F.to_date("created_at"), F.date_add(F.to_date("created_at"), POST_LOOKBACK_HOURS // 24))))
    ticks = runs.select("run", F.col("clock").cast(dict(landed.dtypes)["created_at"]).alias("run_at"))
    seen_by = posts.join(F.broadcast(ticks.withColumn("day", F.to_date("run_at"))), "day") \
        .filter(F.col("run") >= F.col("_from")).drop("_from")
    seen_by = lookback(seen_by, "created_at", F.col("run_at"), POST_LOOKBACK_HOURS)
    w = Window.partitionBy("run", "account").orderBy(*_newest_first())
    return seen_by.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= F.lit(fetch_per_account))


def _run_batch(spark: SparkSession, batch: DataFrame, batch_id: int, landing: str, sink: str,
               fetch_per_account: int, keep: int) -> None:
    """Lands a batch and runs once for each day of each of its folders.

    A post that no earlier run looked at is not seen.  So where all posts of an
    account are new to a run, its picks are known at once, for all runs in one
    write (``step=0``); the other accounts follow run by run (``step=1``)."""
    batch.withColumn("day", F.to_date("created_at")).write.mode("overwrite").partitionBy("day") \
        .parquet(f"{landing}/batch_id={batch_id}")
    listed = _batch_runs(spark, batch_id, landing)
    if not listed:
        return
    runs = spark.createDataFrame(listed, "run long, folder string, day date, clock string")
    looked_at = materialize(_candidates(spark.read.parquet(landing), runs, batch_id, fetch_per_account))
    types = dict(looked_at.dtypes)

    def picks(before: int, clock: str) -> DataFrame:
        """Ids that runs before this one picked within the retention."""
        oldest = F.lit(clock).cast(types["run_at"]) - F.expr(f"INTERVAL {SEEN_RETENTION_DAYS} DAYS")
        if not path_exists(spark, sink):  # the first run
            return spark.createDataFrame([], f"id {types['id']}")
        got = spark.read.schema(f"id {types['id']}, run_at {types['run_at']}, run long, day date, step int").parquet(sink)
        # days that are all older are pruned before any file is read
        return got.filter((F.col("run") < before) & (F.col("day") >= F.to_date(oldest)) & (F.col("run_at") >= oldest)).select("id")
    again = looked_at.groupBy("id").agg(F.min("run").alias("_first"), F.max("run").alias("_last")) \
        .filter("_first < _last").select("id", "_first")
    if batch_id:
        again = again.unionByName(picks(listed[0][0], listed[0][3]).distinct().withColumn("_first", F.lit(-1).cast("long"))) \
            .groupBy("id").agg(F.min("_first").alias("_first"))
    known = looked_at.select("run", "account", "id").join(again, "id").filter("run > _first") \
        .select(F.col("run").alias("_run"), F.col("account").alias("_account")).distinct()
    known = materialize(known)
    same = (F.col("run") == F.col("_run")) & F.col("account").eqNullSafe(F.col("_account"))
    (looked_at.join(known, same, "left_anti").filter(F.col("place") <= F.lit(keep)).drop("place").withColumn("step", F.lit(0))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "day", "step").parquet(sink))
    rest = looked_at.join(known, same, "left_semi").drop("place")
    following = {r["_run"] for r in known.select("_run").distinct().collect()}  # at most one number a run
    for run, _, _, clock in listed:
        # the last run is always written, so that the sink has a file
        if run in following or run == listed[-1][0]:
            mine = rest.filter(F.col("run") == run)
            seen = picks(run, clock).join(mine.select("id").distinct(), "id", "left_semi")
            picked = cap_per_group(mine, ["account"], _newest_first(), fetch_per_account, seen=seen, on="id", keep=keep)
            picked.drop("run", "day").write.mode("overwrite").parquet(f"{sink}/run={run}/day={clock[:10]}/step=1")


def run_incremental_feed(spark: SparkSession, source_dir: str, schema: str, root: str,
                         fetch_per_account: int = 5, keep: int = KEEP_PER_ACCOUNT) -> str:
    """Run the feed stream over what has landed in ``source_dir`` since it
    last ran, one feed run for each day of a micro-batch, and return the sink
    folder of selected posts (partitioned by run and day).  Folders of
    ``source_dir`` that land in one micro-batch count in order of name."""
    landing, sink = f"{root}/landing", f"{root}/selected"
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source_dir)
    stream = stream.withColumn("folder", F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1))

    def handle(batch: DataFrame, batch_id: int) -> None:
        _run_batch(spark, batch, batch_id, landing, sink, fetch_per_account, keep)

    q = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{root}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return sink


def run_job_state_stream(spark: SparkSession, source_dir: str, schema: str, root: str,
                         files_per_trigger: int = 16) -> DataFrame:
    """Streaming ``max_by`` per job (update mode, state store), written
    per batch; the newest written row per job is its current state."""
    sink = f"{root}/job_updates"
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
              .option("recursiveFileLookup", "true").parquet(source_dir))
    agg = job_states(stream)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    q = (agg.writeStream.outputMode("update").foreachBatch(handle)
         .option("checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    updates = spark.read.parquet(sink)
    w = Window.partitionBy("job_id").orderBy(F.col("batch_id").desc())
    return updates.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "batch_id")


def first_delivery(stream: DataFrame, key: str, ts: str, retention: str = f"{SEEN_RETENTION_DAYS} days") -> DataFrame:
    """T1 (streaming form): drop repeats of a key within the retention
    window with bounded state (``dropDuplicatesWithinWatermark``)."""
    return stream.withWatermark(ts, retention).dropDuplicatesWithinWatermark([key])


def run_first_delivery(spark: SparkSession, source_dir: str, schema: str, root: str, key: str, ts: str,
                       retention: str = f"{SEEN_RETENTION_DAYS} days") -> DataFrame:
    """Runs ``first_delivery`` over what has landed since it last ran and
    returns the deliveries of all runs."""
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source_dir)
    q = (first_delivery(stream, key, ts, retention).writeStream.format("parquet").outputMode("append")
         .option("path", f"{root}/delivered").option("checkpointLocation", f"{root}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(schema).parquet(f"{root}/delivered")
