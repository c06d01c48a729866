"""Arrival order over families of inputs, names inside names, late batches."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from curation.operators.dedupe import dedupe_best
from curation.plans.harvest import collect_sources
from curation.sources import notes as N
from curation.streaming.incremental import run_incremental_feed, scratch_root

FIELDS = "url string, canonical_url string, title string, body string, source_type string, method string, " \
    "errors array<string>, metadata map<string,string>"


def test_arrival_order_of_many_items(spark):
    links = spark.createDataFrame([(5_000_000_000, "https://one.test/a")], "pos long, url string")
    row = ("https://one.test/a", "https://one.test/a", "t", "b", "s", "m", [], {})
    feeds = spark.createDataFrame([(f, p, *row) for f in (0, 1) for p in (2, 11, 25)], "feed_id long, pos int, " + FIELDS)
    stars = spark.createDataFrame([(1, 3, *row)], "page_no long, pos int, " + FIELDS)
    src = collect_sources(links, spark.createDataFrame([], "url string, html string"), feed_sources=feeds,
                          star_sources=stars).withColumn("quality_score", F.lit(1))
    got = [tuple(r) for r in src.select("ordinal.*").orderBy("ordinal").collect()]
    assert got == [(0, 0, 5_000_000_000), (1, 1, 3), (2, 0, 2), (2, 0, 11), (2, 0, 25), (2, 1, 2), (2, 1, 11), (2, 1, 25)]
    assert [tuple(r.ordinal) for r in dedupe_best(src).collect()] == [got[0]]


def test_names_with_inner_suffix(spark):
    texts = ["see x.md and .mdb.md.md", "tail.mdx", "", "q.md.r.md.md", "é.md" * 50, ".md"]
    names = ["x.md", "b.md.md", "b.md", "md.md", "tail.md", "r.md.md", "q.md.r.md.md", "é.md", "none.md", "z.md.md.md", "c.md"]
    notes = spark.createDataFrame([(f"/v{N.SYNTHESIS_LAYER}s{i}.md", t) for i, t in enumerate(texts)]
                                  + [(f"/v{N.RAW_LAYER}{n}", None) for n in names] + [(f"/v{N.RAW_LAYER}plain", "")],
                                  "path string, md string")
    want = {n for n in names if not any(n in t for t in texts)} | {"plain"}
    got = N.unsynthesised(N.ingest_notes(notes))
    assert {r.path.split("/")[-1] for r in got.collect()} == want
    assert "NestedLoop" not in got._jdf.queryExecution().toString()
    assert N.unsynthesised(N.ingest_notes(notes.limit(0))).count() == 0


def test_late_batch_keeps_the_clock(spark):
    root = scratch_root(spark, "late")
    t = datetime(2024, 1, 10, 12)
    cols = "account string, id string, created_at timestamp_ntz, type string"
    for name, rows in (("a", [("u", "new", t, "post")]), ("b", [("u", "late", t - timedelta(days=2), "post"),
                                                              ("u", "near", t - timedelta(hours=3), "post")])):
        spark.createDataFrame(rows, cols).coalesce(1).write.parquet(f"{root}/in/{name}")
    out = spark.read.parquet(run_incremental_feed(spark, f"{root}/in", cols, root)).collect()
    assert sorted((r.id, r.run_at) for r in out) == [("near", t), ("new", t)]


def test_feed_runs_over_folders_and_batches(spark):
    """Posts that two runs look at, ids that two accounts share, null accounts
    and late posts, against runs one after the other; what no earlier run
    looked at is written for all runs at once."""
    import random
    rnd = random.Random(5)
    root, t0 = scratch_root(spark, "folders"), datetime(2024, 1, 1)
    cols = "account string, id string, created_at timestamp_ntz, type string"
    batches = [{f: [(rnd.choice(["a", "b", "c", None]), f"i{rnd.randint(0, 60)}", t0 + timedelta(hours=rnd.randint(lo, hi)),
                     rnd.choice(["post", "post", "reply"])) for _ in range(n)] for f, n, lo, hi in part}
               for part in ([("p1", 30, 0, 60), ("p2", 20, 30, 90)], [("q1", 20, 60, 130), ("q2", 6, 300, 310)])]
    landed, seen, want, clock = [], [], [], t0
    for batch in batches:
        for folder in sorted(batch):
            rows = batch[folder]
            spark.createDataFrame(rows, cols).coalesce(2).write.parquet(f"{root}/in/{folder}")
            for day in sorted({r[2].date() for r in rows}):
                new = [r for r in rows if r[2].date() == day]
                landed += new
                clock = max([clock] + [r[2] for r in new])
                known = {i for i, at in seen if at >= clock - timedelta(days=7)}
                for acc in ("a", "b", "c", None):
                    mine = sorted((r for r in landed if r[0] == acc and r[3] != "reply" and r[2] >= clock - timedelta(hours=24)),
                                  key=lambda r: (r[2], r[1]), reverse=True)[:5]
                    want += [(str(acc), r[1], r[2], clock) for r in [r for r in mine if r[1] not in known][:3]]
                seen += [(i, at) for _, i, _, at in want if at == clock]
        sink = run_incremental_feed(spark, f"{root}/in", cols, root)
    out = spark.read.parquet(sink)
    assert sorted((str(r.account), r.id, r.created_at, r.run_at) for r in out.collect()) == sorted(want)
    assert {r.step for r in out.select("step").distinct().collect()} == {0, 1}
