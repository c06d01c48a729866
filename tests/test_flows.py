"""Whole flows on small tables: job queue, digest input, nested account feed,
feed cache, routed documents, gates."""

import datetime as dt
import random

from pyspark.sql import functions as F

from curation.functions import html as H
from curation.functions import quality as Q
from curation.operators import feeds as FD
from curation.operators import records as R
from curation.operators.chunk import route_documents
from curation.sources.pages import resolve_cache
from curation.streaming.jobs import first_at_or_after, job_flow

BASE = dt.datetime(2024, 3, 1)
JOBS = "job_id long, url string, run_id string, created_at timestamp"
DONE = ("job_id long, ts timestamp, ok boolean, url string, run_id string, raw_text string, chars int, "
        "language string, error string")


def at(minutes):
    return BASE + dt.timedelta(minutes=minutes)


def test_first_at_or_after(spark):
    rnd = random.Random(5)
    for spread in (50, 2000, 40_000):
        marks = [at(rnd.randint(0, spread)) for _ in range(25)]
        rows = [(i, at(rnd.randint(0, spread + 90))) for i in range(80)] + [(80, marks[0]), (81, None), (82, marks[0])]
        df = spark.createDataFrame(rows, "i int, t timestamp")
        m = spark.createDataFrame([(x,) for x in [*marks, marks[0], None]], "ts timestamp")
        got = {r.i: r.p for r in first_at_or_after(df, "t", m, "ts", "p").collect()}
        assert got == {i: min((x for x in marks if t is not None and x >= t), default=None) for i, t in rows}
    assert [r.p for r in first_at_or_after(df.limit(1), "t", m.limit(0), "ts", "p").collect()] == [None]


def test_job_flow(spark):
    jobs = spark.createDataFrame([(i, f"u{i}", "r", at(10 * i)) for i in range(6)], JOBS)
    polls = spark.createDataFrame([(at(15),), (at(30),)], "ts timestamp")
    done = spark.createDataFrame([
        (0, at(20), True, "u0", "r", "hello 😀", 0, None, None), (1, at(5), False, "u1", "r", None, None, "", ""),
        (2, at(21), False, "u2", "r", None, None, "en", "no audio"), (9, at(40), None, "u9", "r", None, None, None, None)], DONE)
    queue, outcomes = job_flow(jobs, polls, done)
    # the report on job 1 came before the job, so the job stays
    assert sorted((r.job_id, r.status, r.picked_at) for r in queue.collect()) == [
        (1, "processing", at(15)), (3, "processing", at(30)), (4, "pending", None), (5, "pending", None)]
    out = {r.job_id: r for r in outcomes.collect()}
    assert out[0].forwarded and (out[0].chars, out[0].language, out[0].transcript) == (8, "zh+en", "hello 😀")
    assert [out[i].reason for i in (0, 1, 2, 9)] == [None, "mac_failed", "no audio", "mac_failed"]
    assert out[2].title is None and job_flow(jobs.limit(0), polls, done.limit(0))[0].count() == 0


def test_missing_feeds(spark):
    runs = spark.createDataFrame([("a",), ("b",), ("c",)], "run string")
    feeds = spark.createDataFrame([("a", "x", at(1)), ("a", "podcasts", at(2)), ("b", "podcasts", at(3))],
                                  "run string, kind string, generated_at timestamp")
    entries = spark.createDataFrame([("a", "x", 2), ("a", "x", 3), ("a", "podcasts", None), ("b", "x", 4), ("b", "podcasts", None)],
                                    "run string, kind string, n_posts int")
    head, kept = FD.assemble_feeds(runs, feeds, entries)
    got = {r.run: (r.podcast_episodes, r.x_builders, r.total_posts, r.feed_generated_at, r.errors) for r in head.collect()}
    no_x, no_p = FD.MISSING_FEED["x"], FD.MISSING_FEED["podcasts"]
    assert got == {"a": (1, 2, 5, at(1), []), "b": (1, 0, 0, at(3), [no_x]), "c": (0, 0, 0, None, [no_x, no_p])}
    assert kept.count() == 4


def test_account_feed_needs_a_user(spark):
    posts = spark.createDataFrame([("ann", "1", at(0)), ("ann", "2", at(1)), ("bob", "3", at(2))], "account string, id string, created_at timestamp")
    for c, v in (("text", ""), ("url", ""), ("likes", 1), ("retweets", 0), ("replies", 0), ("is_quote", False), ("quoted_id", None)):
        posts = posts.withColumn(c, F.lit(v))
    accounts = FD.resolve_accounts(spark.createDataFrame([("ann",), ("bob",)], "handle string"),
                                   spark.createDataFrame([("ANN", 7, "Ann", "bio")], "username string, user_id int, name string, bio string"))
    feed = FD.feed_by_account(posts, accounts).collect()
    assert [(r.account, r.name, [p.id for p in r.posts]) for r in feed] == [("ann", "Ann", ["2", "1"])]


def test_feed_cache_keeps_the_document(spark):
    xml = "<rss><channel><item><title>a &amp; b</title></item></channel></rss>"
    req = spark.createDataFrame([("https://f.example/rss",), ("https://f.example/gone",)], "url string")
    fetched = spark.createDataFrame([("https://f.example/rss", xml)], "url string, html string")
    empty = spark.createDataFrame([], "url_hash string, title string, text string")
    first, update = resolve_cache(req, empty, fetched, feed=True)
    assert {(r.method, r.text) for r in first.collect()} == {("feed_fetch", xml), ("fetch_failed", None)}
    again, _ = resolve_cache(req.limit(1), update.select("url_hash", "title", "text"), fetched, feed=True)
    assert [(r.method, r.text) for r in again.collect()] == [("feed_cache", xml)]


def test_routes_gates_and_content(spark):
    body = ["short", "x" * 2999, "y " * 2000, "z" * 10_000, "w" * 10_001, "", None]
    df = spark.createDataFrame(list(enumerate(body)), "k int, text string")
    parts = {}
    for r in sorted(route_documents(df, "text", ["k"]).collect(), key=lambda r: (r.k, r.part_no)):
        parts.setdefault((r.k, r.route), []).append(r.part)
    assert [k for k in parts if k[0] < 6] == [(0, "full"), (1, "full"), (2, "segmented"), (3, "segmented"), (4, "light"), (5, "full")]
    assert "".join(parts[3, "segmented"]) == body[3] and max(map(len, parts[3, "segmented"])) == 3000
    gate = df.select("k", Q.transcript_gate(F.col("text")).alias("g")).collect()
    assert [(r.g.usable, r.g.too_short) for r in gate] == [(False, True), *[(True, False)] * 4, (False, True), (False, True)]
    assert R.has_content(df.union(spark.createDataFrame([(9, " 　\n")], "k int, text string")), "text").count() == 5
    page = spark.createDataFrame([('<title> A&amp;B </title><meta name="description" content="d"><meta property="og:description" content="o">',)], "h string")
    assert [tuple(r.m) for r in page.select(H.collector_meta(F.col("h")).alias("m")).collect()] == [("A&B", "o")]
