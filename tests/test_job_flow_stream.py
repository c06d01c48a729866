"""The streamed queue against the batch flow, with a stop in between."""

import datetime as dt
import random

from pyspark.sql import functions as F

from curation.streaming.incremental import scratch_root
from curation.streaming.job_flow import queue_events, run_job_flow_stream
from curation.streaming.jobs import job_flow


def test_stream_equals_batch_after_a_restart(spark):
    rnd = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)

    def at(i):
        return t0 + dt.timedelta(minutes=i)
    jobs = [(i, f"u{i}", "r", at(rnd.randint(0, 90))) for i in range(60)]
    polls = [(at(i),) for i in (0, 20, 20, 45, 70)]
    done = [(i, at(rnd.randint(0, 100)), rnd.random() < 0.6, f"u{i}", "r", "text", rnd.choice([0, 7, None]), rnd.choice(["", "en"]),
             rnd.choice([None, "", "broken"])) for i in rnd.sample(range(70), 40)]
    j = spark.createDataFrame(jobs, "job_id long, url string, run_id string, created_at timestamp_ntz")
    p = spark.createDataFrame(polls, "ts timestamp_ntz")
    d = spark.createDataFrame(done, "job_id long, ts timestamp_ntz, ok boolean, url string, run_id string, raw_text string, "
                                    "chars int, language string, error string")
    root = scratch_root(spark, "test-flow")
    log = queue_events(j, p, d)
    early = F.col("ts") < F.lit("2024-01-01 00:40:00").cast("timestamp_ntz")
    log.filter(early).write.parquet(f"{root}/source/part=1")
    run_job_flow_stream(spark, f"{root}/source", root, shards=3)
    log.filter(~early).write.parquet(f"{root}/source/part=2")
    got = run_job_flow_stream(spark, f"{root}/source", root, shards=3)
    for x, y in zip(got, job_flow(j, p, d)):
        assert x.columns == y.columns
        assert sorted(map(str, x.collect())) == sorted(map(str, y.collect()))


def test_open_jobs_are_rows_in_no_python_task(spark):
    t0 = dt.datetime(2024, 1, 1)
    root = scratch_root(spark, "test-open")
    cols = {"j": "job_id long, url string, run_id string, created_at timestamp_ntz", "p": "ts timestamp_ntz",
            "d": "job_id long, ts timestamp_ntz, ok boolean, url string, run_id string, raw_text string, chars int, "
                 "language string, error string"}
    big = 2**60 + 1  # no double holds it

    def land(part, jobs, polls, done):
        log = queue_events(*(spark.createDataFrame(r, cols[k]) for k, r in (("j", jobs), ("p", polls), ("d", done))))
        log.coalesce(1).write.parquet(f"{root}/source/part={part}")
        return run_job_flow_stream(spark, f"{root}/source", root)

    def at(i):
        return t0 + dt.timedelta(minutes=i)
    # 1 is claimed, 2 waits, 3 is reported before any poll; a report of nothing
    land(1, [(1, "u", "r", at(0)), (2, "u", "r", at(9)), (2, "u", "r", at(9)), (3, "u", "r", at(1))], [(at(5),)],
         [(3, at(4), True, "u", "r", "t", 1, "en", None), (99, at(4), False, "u", "r", "t", 1, "en", None)])
    # later: 2 is claimed by an older poll than its own time, 1 is removed
    queue, outcomes = land(2, [(big, "u", "r", at(20))], [(at(7),), (at(8),)], [(1, at(6), True, "u", "r", "t", 1, "en", None)])
    assert sorted((r.job_id, r.status, r.picked_at) for r in queue.collect()) == [(2, "processing", at(7)), (big, "pending", None)]
    assert sorted(r.job_id for r in outcomes.collect()) == [1, 3, 99]
    plans = [d._jdf.queryExecution().toString() for d in (queue, outcomes)]
    assert not any("Pandas" in p or "Python" in p for p in plans)
    from curation.streaming.job_flow import _touched_jobs
    events = spark.read.parquet(f"{root}/source").drop("part")
    before = spark.read.parquet(f"{root}/open/1")
    plan = _touched_jobs(events, before)._jdf.queryExecution().toString()
    assert "Pandas" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
