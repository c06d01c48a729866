"""Incremental social feeds: post ingestion, lookback and type filters,
per-account caps with seen-state, account resolution, layered lookups and
the nested feed output."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curation.operators.topk import cap_per_group

# Feed defaults (lookback hours, per-account fetch and keep counts).
POST_LOOKBACK_HOURS = 24
VIDEO_LOOKBACK_HOURS = 72
FETCH_PER_ACCOUNT = 5
KEEP_PER_ACCOUNT = 3
SEEN_RETENTION_DAYS = 7
# Post types dropped before the cap.
EXCLUDED_TYPES = ["retweet", "reply"]
# Errors of feeds that could not be fetched.
MISSING_FEED = {"x": "Could not fetch tweet feed", "podcasts": "Could not fetch podcast feed"}

POSTS_SCHEMA = ("account string, id string, created_at timestamp, text string, note_text string, type string, "
                "metrics struct<like_count:int,retweet_count:int,reply_count:int>, "
                "referenced array<struct<type:string,id:string>>")


def ingest_posts(posts: DataFrame) -> DataFrame:
    """Flat posts with long-note text, zero-default metrics, quote flags
    and permalink."""
    ref = F.coalesce(F.col("referenced"), F.array().cast("array<struct<type:string,id:string>>"))
    quoted = F.filter(ref, lambda r: r["type"] == "quoted")
    return posts.select(
        "account", "id", "created_at", "type",
        F.coalesce(F.when(F.col("note_text") != "", F.col("note_text")), F.col("text")).alias("text"),
        F.concat(F.lit("https://x.com/"), F.col("account"), F.lit("/status/"), F.col("id")).alias("url"),
        F.coalesce(F.col("metrics.like_count"), F.lit(0)).alias("likes"),
        F.coalesce(F.col("metrics.retweet_count"), F.lit(0)).alias("retweets"),
        F.coalesce(F.col("metrics.reply_count"), F.lit(0)).alias("replies"),
        (F.size(quoted) > 0).alias("is_quote"),
        F.try_element_at(quoted, F.lit(1))["id"].alias("quoted_id"),
    )


def lookback(df: DataFrame, ts: str, as_of: Column, hours: int) -> DataFrame:
    """keep rows at or after ``as_of - hours`` (NULL times dropped)."""
    return df.filter(F.col(ts) >= as_of - F.expr(f"INTERVAL {hours} HOURS"))


def exclude_types(df: DataFrame, col: str = "type", types: Sequence[str] = EXCLUDED_TYPES) -> DataFrame:
    """drop reposts and replies."""
    return df.filter(~F.coalesce(F.col(col).isin(list(types)), F.lit(False)))


def select_new_posts(posts: DataFrame, seen: DataFrame, as_of: Column) -> DataFrame:
    """One feed run: lookback, type filter, newest 5 per account, drop seen,
    first 3.  Unselected posts stay unseen for the next run."""
    p = exclude_types(lookback(posts, "created_at", as_of, POST_LOOKBACK_HOURS))
    return cap_per_group(p, ["account"], [F.col("created_at").desc(), F.col("id").desc()],
                         FETCH_PER_ACCOUNT, seen=seen.withColumnRenamed("seen_id", "id"), on="id",
                         keep=KEEP_PER_ACCOUNT)


def feed_by_account(selected: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """K3: one nested row per account that has new posts (others omitted),
    with name and bio when ``accounts`` (as ``resolve_accounts`` gives them)
    are passed; accounts that were not found then have no feed.  The cap per
    account bounds the nested posts."""
    post = F.struct("id", "text", "created_at", "url", "likes", "retweets", "replies", "is_quote", "quoted_id")
    g = selected.groupBy("account").agg(
        F.sort_array(F.collect_list(F.struct(F.col("created_at").alias("_t"), F.col("id").alias("_i"),
                                             post.alias("p"))), asc=False).alias("_ps"))
    g = g.select("account", F.transform("_ps", lambda x: x["p"]).alias("posts"),
                 F.size("_ps").alias("n_posts"))
    if accounts is not None:
        found = accounts.filter(F.col("error").isNull())
        g = g.join(found.select(F.col("handle").alias("account"), "name", "bio"), "account")
    return g


def feed_stats(selected: DataFrame) -> DataFrame:
    """Accounts with posts and total posts (one row)."""
    return selected.agg(F.count_distinct("account").alias("x_builders"), F.count("*").alias("total_posts"))


def resolve_accounts(accounts: DataFrame, users: DataFrame) -> DataFrame:
    """Handle -> (user_id, name, bio), case-insensitive; unresolved
    handles carry an error instead.  ``users(username, user_id, name, bio)``."""
    u = users.select(F.lower("username").alias("_k"), "user_id", "name", "bio")
    a = accounts.withColumn("_k", F.lower("handle"))
    out = a.join(u, "_k", "left").drop("_k")
    return out.withColumn("error", F.when(F.col("user_id").isNull(),
                                          F.concat(F.lit("X API: User not found: "), F.col("handle"))))


def assemble_feeds(runs: DataFrame, feeds: DataFrame, entries: DataFrame, run: str = "run"
                   ) -> tuple[DataFrame, DataFrame]:
    """``(headers, entries)`` of the combined digest input.

    ``runs(run)`` are the digest runs, ``feeds(run, kind, generated_at)`` the
    feeds that were fetched for them (kinds ``x`` and ``podcasts``) and
    ``entries(run, kind, n_posts, ...)`` their entries.  A header row holds
    the statistics, the time of the post feed (else of the podcast feed) and
    an error for each feed that is missing; a missing feed has no entries.
    Entries stay rows, so a run of any size is spread over tasks.
    """
    there = feeds.filter(F.col("kind").isin(*MISSING_FEED)).groupBy(run, "kind").agg(
        F.max("generated_at").alias("generated_at"))
    kept = entries.join(there.select(run, "kind"), [run, "kind"], "left_semi")
    none = F.lit(None)
    facts = runs.select(run, none.cast("string").alias("kind"), F.lit(False).alias("entry"),
                        none.cast("long").alias("n_posts"), none.cast(dict(feeds.dtypes)["generated_at"]).alias("generated_at"))
    for rows, entry, posts, at in ((there, False, none, F.col("generated_at")), (kept, True, F.col("n_posts"), none)):
        facts = facts.unionByName(rows.select(run, "kind", F.lit(entry).alias("entry"), posts.cast("long").alias("n_posts"),
                                              at.cast(dict(feeds.dtypes)["generated_at"]).alias("generated_at")))
    x, pod = F.col("kind") == "x", F.col("kind") == "podcasts"
    head = facts.groupBy(run).agg(
        F.count_if(pod & F.col("entry")).alias("podcast_episodes"), F.count_if(x & F.col("entry")).alias("x_builders"),
        F.coalesce(F.sum(F.when(x, F.col("n_posts"))), F.lit(0)).alias("total_posts"),
        F.coalesce(F.max(F.when(x, F.col("generated_at"))), F.max(F.when(pod, F.col("generated_at"))))
        .alias("feed_generated_at"),
        F.array_compact(F.array(*[F.when(F.count_if(F.col("kind") == k) == 0, F.lit(e))
                                  for k, e in MISSING_FEED.items()])).alias("errors"))
    return runs.select(run).distinct().join(head, run), kept


def layered_lookup(keys: DataFrame, layers: Sequence[tuple[DataFrame, bool]]) -> DataFrame:
    """The value of the first layer that has the key.

    ``layers`` are ``(df(key, value), empty_counts)`` in precedence order; a
    layer with ``empty_counts=False`` falls through on an empty value.
    Keys no layer has get ``error``.
    """
    parts = []
    for rank, (df, empty_counts) in enumerate(layers):
        d = df.select("key", "value", F.lit(rank).alias("layer"))
        if not empty_counts:
            d = d.filter(F.col("value").isNotNull() & (F.col("value") != ""))
        parts.append(d)
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    best = union.groupBy("key").agg(F.min_by(F.struct("value", "layer"), F.col("layer")).alias("b"))
    out = keys.select("key").join(best, "key", "left")
    return out.select("key", F.col("b.value").alias("value"), F.col("b.layer").alias("layer"),
                      F.when(F.col("b").isNull(), F.concat(F.lit("Could not load: "), F.col("key")))
                      .alias("error"))
