import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from brute import best_selection, selection_faults
from curation.functions.scoring import score_sources
from curation.operators.budget import PRUNE_ROWS, _partial_topk_factory, budget_candidates, select_for_budget


def _sources(spark, rows):
    return spark.createDataFrame(rows, "canonical_url string, quality_score int, priority int, approx_tokens int")


def _picked(df):
    return {r.canonical_url: r.selected_tokens for r in df.filter("selected").collect()}


def test_budget_selects_highest_quality(spark):
    # Two 1000-char bodies; the priority domain wins a 300-token budget.
    src = spark.createDataFrame(
        [("https://github.com/a/b", "https://github.com/a/b", "high", "a" * 1000, "fetch", 0),
         ("https://low.example/item", "https://low.example/item", "low", "b" * 1000, "fetch", 1)],
        "url string, canonical_url string, title string, body string, method string, ordinal long")
    src = src.withColumn("errors", F.array().cast("array<string>"))
    sel = select_for_budget(score_sources(src, ["github.com"]), 300, 300)
    got = {r.canonical_url: r.selected for r in sel.collect()}
    assert got == {"https://github.com/a/b": True, "https://low.example/item": False}


def test_skip_and_continue_equal_scores_and_zero_budget(spark):
    rows = [("a", 10, 0, 50), ("b", 10, 0, 5), ("c", 9, 0, 2), ("d", 10, 0, 6)]
    df = _sources(spark, rows)
    # 'a' does not fit, later smaller rows still do; ties ordered by URL.
    assert _picked(select_for_budget(df, 12, 100)) == best_selection(rows, 12, 100) == {"b": 5, "d": 6}
    assert _picked(select_for_budget(df, 0, 100)) == {}


def test_greedy_walk_on_random_inputs(spark):
    rnd = random.Random(3)
    for case in range(6):
        n = rnd.randint(50, 400)
        rows = [(f"u{i:04d}", rnd.randint(0, 60), rnd.randint(0, 3), rnd.choice([1, 2, 3, rnd.randint(1, 2000)]))
                for i in range(n)]
        budget, cap = rnd.choice([(4000, 900), (777, 300), (50, 7), (20000, 900)])
        picked = _picked(select_for_budget(_sources(spark, rows), budget, cap))
        assert not selection_faults(rows, budget, cap, picked), case


def test_per_key_budgets(spark):
    rows = [("k1", "a", 5, 0, 8), ("k1", "b", 4, 0, 3), ("k2", "c", 5, 0, 9), ("k2", "d", 1, 0, 1)]
    df = spark.createDataFrame(rows, "k string, canonical_url string, quality_score int, priority int, "
                                     "approx_tokens int")
    got = _picked(select_for_budget(df, 9, 100, keys=["k"]))
    assert got == {"a": 8, "c": 9}


def test_partial_topk_holds_few_rows_with_a_million_keys():
    topk = _partial_topk_factory(4000, ["k"])
    seen = []

    def batches():
        for at in range(0, 1_000_000, 10_000):
            i = np.arange(at, at + 10_000)
            seen.append(len(i))
            yield pd.DataFrame({"k": i, "canonical_url": "u", "quality_score": 1, "priority": 0, "needed": 900})
    rows, sent = 0, 0
    for out in topk(batches()):
        assert len(out) <= PRUNE_ROWS + 10_000 and sum(seen) - sent <= PRUNE_ROWS + 10_000
        rows, sent = rows + len(out), sent + len(out)
    assert rows == 1_000_000
    # one key: every batch is pruned to its bound
    few = topk(pd.DataFrame({"k": 0, "canonical_url": [f"u{x}" for x in range(at, at + 10_000)], "quality_score": 1,
                             "priority": 0, "needed": 900}) for at in range(0, 300_000, 10_000))
    assert [f["canonical_url"].tolist() for f in few] == [["u0", "u1", "u10", "u100"]]


def test_many_keys_each_with_a_budget(spark):
    df = spark.range(150_000).select(
        F.concat(F.lit("k"), F.col("id") % 50_000).alias("k"), F.concat(F.lit("u"), F.col("id")).alias("canonical_url"),
        (F.col("id") / 50_000).cast("int").alias("quality_score"), F.lit(0).alias("priority"), F.lit(5).alias("approx_tokens"))
    got = select_for_budget(df, 9, 100, keys=["k"])
    assert got.filter("selected").agg(F.count("*"), F.min("quality_score")).first()[:] == (50_000, 2)


def test_candidates_are_bounded_and_group_limited(spark):
    # 3000 rows in one token class: only floor(B / n) can ever be picked.
    rows = [(f"u{i}", i % 7, 0, 900) for i in range(3000)]
    df = _sources(spark, rows)
    cand = budget_candidates(df, 4000, 900)
    assert cand.count() == 4  # floor(4000 / 900)
    plan = cand._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "BroadcastNestedLoopJoin" not in plan
