"""Ranking limits: top digest (W3), per-account caps (W4), oldest unseen
video (W5), per-feed limits (W6) and bounded samples (W7).

Per-group limits use ``row_number() <= literal`` so that Spark inserts a
partial ``WindowGroupLimit`` before the shuffle; global top-k uses
``orderBy().limit()`` (``TakeOrderedAndProject``), never a global window.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curation.functions.quality import keyword_any
from curation.functions.text import py_strip

# Keywords that send a digest item to the deep-dive list.
DEEP_DIVE_KEYWORDS = ["obsidian", "wiki", "agent", "context", "codex", "claude"]


def top_digest(items: DataFrame, n: int = 5, deep_n: int = 3, order_extra: Sequence[str] = ()) -> DataFrame:
    """Top ``n`` items by (score desc, title asc); ``deep`` marks the first
    ``deep_n`` of them whose title + body hit a deep-dive keyword."""
    order = [F.col("score").desc(), F.col("title").asc()] + [F.col(c).asc() for c in order_extra]
    top = items.orderBy(*order).limit(n)
    w = Window.partitionBy(F.lit(1)).orderBy(*order)  # over at most n rows
    top = top.withColumn("rank", F.row_number().over(w))
    hit = keyword_any(F.concat(F.col("title"), F.col("body")), DEEP_DIVE_KEYWORDS)
    top = top.withColumn("_hit", hit)
    wd = Window.partitionBy("_hit").orderBy("rank")
    top = top.withColumn("deep", F.col("_hit") & (F.row_number().over(wd) <= deep_n)).drop("_hit")
    return top.withColumn("summary", F.substring(py_strip(F.replace(F.col("body"), F.lit("\n"), F.lit(" "))), 1, 160))


def cap_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], first: int,
                  seen: DataFrame | None = None, on: str = "id", keep: int | None = None) -> DataFrame:
    """First ``first`` rows per group, then drop ids in ``seen``, then the
    first ``keep`` of the rest (the three steps do not commute)."""
    w = Window.partitionBy(*group).orderBy(*order)
    out = df.withColumn("_r1", F.row_number().over(w)).filter(F.col("_r1") <= F.lit(first)).drop("_r1")
    if seen is not None:
        out = out.join(seen.select(on).distinct(), on, "left_anti")
    if keep is not None:
        out = out.withColumn("_r2", F.row_number().over(w)).filter(F.col("_r2") <= F.lit(keep)).drop("_r2")
    return out


def oldest_unseen(videos: DataFrame, seen: DataFrame, as_of: Column, hours: int = 72, per_channel: int = 2,
                  on: str = "video_id") -> DataFrame:
    """First ``per_channel`` videos of each channel in list order, minus
    seen ones, published within ``hours`` of ``as_of``; the oldest one."""
    w = Window.partitionBy("channel").orderBy("pos")
    cand = videos.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= F.lit(per_channel)).drop("_r")
    cand = cand.join(seen.select(on).distinct(), on, "left_anti")
    cand = cand.filter(F.col("published_at").isNotNull()
                       & (F.col("published_at") >= as_of - F.expr(f"INTERVAL {hours} HOURS")))
    return cand.orderBy("published_at", "channel_order", "pos").limit(1)


def limit_per_feed(items: DataFrame, limits: DataFrame) -> DataFrame:
    """The first ``limit`` items with a URL of each feed, in document
    order.  ``limits(feed_id, limit)``; feeds with ``limit <= 0`` read nothing.

    The per-feed bound is data; the largest configured limit (one value from
    the small feed table) becomes the literal group limit, so the limit fires
    before the shuffle and no feed is ever cut below its own limit.
    """
    live = limits.filter(F.col("limit") > 0)
    top = live.agg(F.max("limit")).first()[0]
    valid = items.filter(F.col("url").isNotNull() & (F.col("url") != ""))
    if top is None:
        return valid.join(live, "feed_id", "inner").limit(0)
    # The feed table is configuration, not data with a proven bound: AQE
    # broadcasts it at run time when its measured size is small.
    valid = valid.join(live, "feed_id", "inner")
    w = Window.partitionBy("feed_id").orderBy("pos")
    return (valid.withColumn("_r", F.row_number().over(w))
            .filter((F.col("_r") <= F.lit(int(top))) & (F.col("_r") <= F.col("limit"))).drop("_r"))


def bounded_sample(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by a total order."""
    return df.orderBy(*order).limit(n)
