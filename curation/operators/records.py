"""Collected records: transcripts (S11), combined text (A8), coverage (A9),
handoff items (K4), queue split (U2), raw-text intake (S14), platform set
(A7), manual text (J2) and short social posts (S9).

Per-run outputs group by a run key; a run is one collection request, so
its size is bounded by the request, never by the table.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curation.functions.quality import platform, quality_gate
from curation.functions.text import py_strip, utf16_length
from curation.functions.urls import canonical_url, is_x_url, post_id

INJECT_LANGUAGE = "zh+en"
INJECT_MIN_CHARS = 300
# Manual fallback note and error of unfetched social posts.
X_MANUAL_NOTE = "Paste tweet/thread text or screenshots for full extraction."
X_MANUAL_ERROR = "x_manual_fallback_required"
QUEUE_REASON = "queued_for_mac_worker"


def assemble_transcripts(segments: DataFrame, key: str = "doc", seq: str = "seq", text: str = "text") -> DataFrame:
    """Ordered segments of one document joined by a single space."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), F.col(text).alias("t"))))
    return segments.groupBy(key).agg(F.array_join(F.transform(parts, lambda x: x["t"]), " ").alias("body"),
                                     F.count("*").alias("n_segments"))


def has_content(records: DataFrame, text: str = "body") -> DataFrame:
    """the records whose text is not blank."""
    return records.filter(py_strip(F.coalesce(text, F.lit(""))) != "")


def combine_texts(records: DataFrame, run: str = "run", order: str = "ordinal") -> DataFrame:
    """Per run, ``[platform] title\\nbody`` of records with a non-blank
    body, in input order, joined by a blank line."""
    ok = has_content(records)
    item = F.concat(F.lit("["), F.col("platform"), F.lit("] "), F.coalesce("title", F.lit("")), F.lit("\n"),
                    F.col("body"))
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), item.alias("t"))))
    return ok.groupBy(run).agg(F.array_join(F.transform(parts, lambda x: x["t"]), "\n\n").alias("combined_text"))


def coverage(records: DataFrame, run: str = "run", order: str = "ordinal") -> DataFrame:
    """Per run, ok / total counts, whether any content exists and the
    failed records (input order) as JSON."""
    ok = py_strip(F.coalesce("body", F.lit(""))) != ""
    failed = F.array_sort(F.collect_list(F.when(~ok, F.struct(F.col(order).alias("o"), F.col("url").alias("url"),
                                                              F.col("platform").alias("platform")))))
    return records.groupBy(run).agg(
        F.count_if(ok).alias("ok_count"), F.count("*").alias("total_count"),
        F.bool_or(ok).alias("has_content"),
        F.to_json(F.transform(failed, lambda x: F.struct(x["url"].alias("url"), x["platform"].alias("platform"))))
        .alias("need_supplement_json"))


def handoff_items(records: DataFrame) -> DataFrame:
    """K4: records in the hand-off schema; records without text dropped."""
    gate = quality_gate(F.col("title"), F.col("body"))
    return records.filter(F.coalesce(F.col("body"), F.lit("")) != "").select(
        *[c for c in ("run", "ordinal") if c in records.columns],
        F.when(F.col("platform") == "xiaohongshu", "xhs").otherwise(F.col("platform")).alias("source_type"),
        F.col("url").alias("source_url"), F.coalesce("title", F.lit("")).alias("title"),
        F.col("body").alias("transcript"), F.lit(INJECT_LANGUAGE).alias("language"),
        gate["chars"].alias("chars"), F.coalesce("method", F.lit("")).alias("method"))


def handoff_need_materials(need: DataFrame) -> DataFrame:
    """K4: need-material rows with defaults (``fail_reason`` -> unknown)."""
    return need.select(F.coalesce("source", F.lit("")).alias("source_url"), F.coalesce("got", F.lit("")).alias("got"),
                       F.coalesce("missing", F.lit("")).alias("missing"),
                       F.coalesce("provide", F.lit("")).alias("provide"),
                       F.coalesce(F.when(F.col("fail_reason") != "", F.col("fail_reason")), F.lit("unknown"))
                       .alias("fail_reason"),
                       F.coalesce("errors", F.array().cast("array<string>")).alias("errors"))


def split_route(links: DataFrame, url: str = "url") -> DataFrame:
    """Video links go to the worker queue (a pending job and a
    need-material note), the others are processed in place."""
    video = F.instr(F.col(url), "youtu") > 0
    return links.withColumn("route", F.when(video, "queue").otherwise("process")) \
        .withColumn("status", F.when(video, "pending").otherwise("processing")) \
        .withColumn("fail_reason", F.when(video, F.lit(QUEUE_REASON)))


def raw_text_intake(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``requests(request_id, links, raw_text, language)`` -> (items,
    rejected).  No links rejects the request; the first link sets the type;
    text under 300 UTF-16 units also yields a need-material note."""
    has_links = F.coalesce(F.size("links"), F.lit(0)) > 0
    rejected = requests.filter(~has_links).select("request_id", F.lit("links is required").alias("error"))
    ok = requests.filter(has_links)
    first = F.col("links")[0]
    st = platform(first, vocab="inject")
    raw = F.coalesce("raw_text", F.lit(""))
    n = utf16_length(raw)
    items = ok.select(
        "request_id", st.alias("source_type"), first.alias("source_url"),
        F.concat(st, F.lit(" (本地转录注入)")).alias("title"), raw.alias("transcript"),
        F.coalesce(F.when(F.col("language") != "", F.col("language")), F.lit(INJECT_LANGUAGE)).alias("language"),
        n.alias("chars"), F.lit("manual_inject").alias("method"),
        F.when(n < INJECT_MIN_CHARS, F.lit("正文不足300字")).alias("need_material"))
    return items, rejected


def platform_set(records: DataFrame) -> DataFrame:
    """Distinct platforms of a run (bounded by the vocabulary)."""
    return records.select("platform").distinct()


def attach_manual_text(links: DataFrame, manual: DataFrame, url: str = "url", order: str | None = None) -> DataFrame:
    """Manual text by raw URL, else by canonical URL; empty = missing.

    Of several texts of a URL the last by ``order`` holds (a column of
    ``manual``; the greatest text where none is given).  Keys are settled
    first, without texts: the last row of each URL, then the key that each
    link takes.  A text moves once, and only that of a last row."""
    by = [F.col(order)] if order else []
    m = manual.select("url", F.coalesce("text", F.lit("")).alias("text"), *(c.alias("_order") for c in by))
    if order:
        keys = m.groupBy("url").agg(F.max("_order").alias("_last"), F.max_by(F.col("text") != "", "_order").alias("_any"))
        keys = keys.filter("_any").select("url", "_last")
    else:
        m = m.groupBy("url").agg(F.max("text").alias("text")).withColumn("_order", F.lit(0))
        keys = m.filter("text <> ''").select("url", F.col("_order").alias("_last"))
    raw = keys.select(F.col("url").alias("_raw"), F.col("_last").alias("_raw_last"))
    can = keys.select(F.col("url").alias("_can"), F.col("_last").alias("_can_last"))
    out = links.withColumn("_c", canonical_url(F.col(url)))
    out = out.join(raw, out[url] == raw["_raw"], "left").join(can, F.col("_c") == can["_can"], "left")
    out = out.withColumn("_key", F.coalesce("_raw", "_can")).withColumn("_at", F.when(F.col("_raw").isNotNull(), F.col("_raw_last"))
                                                                        .otherwise(F.col("_can_last")))
    texts = m.select(F.col("url").alias("_url"), F.col("_order").alias("_o"), F.col("text").alias("_text"))
    out = out.join(texts, (F.col("_key") == texts["_url"]) & (F.col("_at") == texts["_o"]), "left")
    return out.withColumn("manual_text", F.coalesce("_text", F.lit(""))).drop(
        "_c", "_raw", "_raw_last", "_can", "_can_last", "_key", "_at", "_url", "_o", "_text")


def short_post_sources(links: DataFrame, url: str = "url", keep: Sequence[str] = ()) -> DataFrame:
    """Social links are not fetched: title from the status id, body from
    manual text, else an error asking for a manual fallback.  ``keep`` are
    own columns to carry along."""
    pid = post_id(F.col(url))
    manual = F.coalesce("manual_text", F.lit(""))
    has = manual != ""
    return links.filter(is_x_url(canonical_url(F.col(url)))).select(
        *keep, F.col(url).alias("url"), canonical_url(F.col(url)).alias("canonical_url"),
        F.when(pid != "", F.concat(F.lit("X/Twitter post "), pid)).otherwise(F.lit("X/Twitter link")).alias("title"),
        py_strip(manual).alias("body"), F.lit("x").alias("source_type"),
        F.when(has, "manual_metadata").otherwise("metadata_only").alias("method"),
        F.when(has, F.array().cast("array<string>")).otherwise(F.array(F.lit(X_MANUAL_ERROR))).alias("errors"),
        F.create_map(F.lit("manual_fallback"), F.lit(X_MANUAL_NOTE)).alias("metadata"))
