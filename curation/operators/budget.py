"""Greedy selection under a token budget, exact at any input size.

The walk visits sources in rank order (quality desc, priority desc,
canonical_url asc) and takes a source when ``needed = min(tokens, cap)``
still fits, otherwise skips it and goes on.  This is not a running sum, but
it prunes exactly: if a source of class ``needed = n`` is taken, every
earlier-ranked source of the same class was taken too (the remaining budget
only shrinks), so at most ``floor(B / n)`` sources per class can ever be
chosen.  Each map task keeps only those per class (an exact partial top-k,
so a dense class ships at most ``floor(B / n)`` rows per task), and a window
per class after the shuffle applies the same bound.  At most ``B * H(cap)``
rows reach the sequential walk whatever the input size; the walk then runs
over all budget keys of a partition in turn, in ``mapInPandas``.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that a map task of the partial top-k holds, at most, before it prunes.
PRUNE_ROWS = 100_000


def rank_order():
    return [F.col("quality_score").desc(), F.col("priority").desc(), F.col("canonical_url").asc()]


def rank_sources(df: DataFrame) -> DataFrame:
    """The total order used for selection and the digest."""
    return df.orderBy(*rank_order())


def _partial_topk_factory(budget: int, keys: list[str]):
    """Per map task: keep, for every (key, needed) class, only its first
    ``floor(budget / needed)`` rows in rank order.

    Rows gather up to ``PRUNE_ROWS`` before they are sorted and pruned.  What
    is left after that is sent on when it is over half of the limit, as with
    many keys: the window behind the shuffle prunes it again, so this is exact
    with memory for ``PRUNE_ROWS`` rows and a batch, whatever the keys."""
    group = keys + ["needed"]
    order = group + ["quality_score", "priority", "canonical_url"]
    ascending = [True] * len(group) + [False, False, True]

    def pruned(parts):
        rows = pd.concat(parts, ignore_index=True).sort_values(order, ascending=ascending, kind="mergesort")
        place = rows.groupby(group, sort=False, dropna=False).cumcount().to_numpy()
        return rows[place < budget // rows["needed"].to_numpy()]

    def keep_top(it):
        parts, held = [], 0
        for pdf in it:
            parts.append(pdf)
            held += len(pdf)
            if held < PRUNE_ROWS:
                continue
            left = pruned(parts)
            if 2 * len(left) > PRUNE_ROWS:
                yield left
                parts, held = [], 0
            else:
                parts, held = [left], len(left)
        if held:
            yield pruned(parts)
    return keep_top


def budget_candidates(df: DataFrame, budget: int, per_source: int, keys: Sequence[str] = ()) -> DataFrame:
    """Rows that could possibly be selected (exact superset of the picks).

    Map side: an exact per-class top-``floor(B/n)`` in every task (tight
    for every class, unlike one literal group limit).  After the shuffle by
    class: the same bound with a window (literal ``B`` so Spark's group limit
    also applies).
    """
    if per_source < 1:
        raise ValueError("per_source_token_limit must be >= 1")
    keys = list(keys)
    needed = F.least(F.col("approx_tokens"), F.lit(per_source)).cast("int")
    narrow = df.select(*keys, "canonical_url", "quality_score", "priority", needed.alias("needed"))
    if budget <= 0:
        return narrow.limit(0).withColumn("_c", F.lit(0))
    narrow = narrow.mapInPandas(_partial_topk_factory(budget, keys), narrow.schema)
    w = Window.partitionBy(*keys, "needed").orderBy(*rank_order())
    return (narrow.withColumn("_c", F.row_number().over(w))
            .filter((F.col("_c") <= F.lit(budget)) & (F.col("_c") <= F.floor(F.lit(budget) / F.col("needed")))))


def _walk_factory(budget: int, columns: list[str]):
    """The greedy walk over rows that stand key by key in rank order; row 1 of
    a key (``_n``) starts its budget.  Only the budget left is kept."""
    def walk(batches):
        left, rank = budget, 0
        for pdf in batches:
            place = np.zeros(len(pdf), dtype=np.int32)
            for i, (cost, n) in enumerate(zip(pdf["needed"].tolist(), pdf["_n"].tolist())):
                if n == 1:
                    left, rank = budget, 0
                if cost <= left:
                    left, rank = left - cost, rank + 1
                    place[i] = rank
            out = pdf.loc[place > 0, columns + ["needed"]].rename(columns={"needed": "selected_tokens"})
            out["pick_rank"] = place[place > 0]  # order among the picks
            yield out
    return walk


def select_for_budget(df: DataFrame, budget: int = 4000, per_source: int = 900,
                      keys: Sequence[str] = ()) -> DataFrame:
    """Mark every source ``selected`` or not and set ``selected_tokens`` and
    ``pick_rank`` (1-based rank among the picks of its key, else NULL).

    ``df`` needs ``canonical_url`` (unique per key), ``quality_score``,
    ``priority`` and ``approx_tokens``; ``keys`` give one budget per key.
    ``df`` is read twice (candidates, join back): pass a narrow,
    materialised table when it is expensive to compute.
    """
    keys = list(keys)
    cand = budget_candidates(df, budget, per_source, keys).drop("_c")
    group = keys or ["_g"]
    if not keys:
        cand = cand.withColumn("_g", F.lit(0))
    walk_order = Window.partitionBy(*group).orderBy(*rank_order())
    cand = cand.withColumn("_n", F.row_number().over(walk_order)).sortWithinPartitions(*group, "_n")
    columns = keys + ["canonical_url"]
    schema = ", ".join([f"{k} {dict(df.dtypes)[k]}" for k in columns] + ["selected_tokens int", "pick_rank int"])
    picks = cand.mapInPandas(_walk_factory(budget, columns), schema)
    out = df.join(picks, on=keys + ["canonical_url"], how="left")
    return (out.withColumn("selected", F.col("selected_tokens").isNotNull())
            .withColumn("selected_tokens", F.coalesce(F.col("selected_tokens"), F.lit(0))))
