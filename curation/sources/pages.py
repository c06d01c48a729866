"""Landed pages (crawl results) to sources, and the fetch-cache resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curation.functions import html as H
from curation.functions.text import py_strip
from curation.functions.urls import cache_key, canonical_url

def empty_errors():
    return F.array().cast("array<string>")


def empty_meta():
    return F.create_map().cast("map<string,string>")


def with_page_fields(df: DataFrame, html: str, out: str = "_p", cleaner: H.Cleaner | None = None) -> DataFrame:
    """``df`` with a struct(title, body, cleaner, description) of the fetched
    documents in column ``html``.

    HTML (``<html`` in the first 500 or ``<title`` in the first 2000 chars):
    title from meta/``<title>``, body = cleaned text, prefixed by the meta
    description unless it already occurs in the first 500 body chars.
    Anything else is plain text: stripped, no title, no scan.
    """
    raw = F.col(html)
    is_html = H.looks_like_html(raw)
    # a column of its own, so that the scan runs once however often it is read
    df = df.withColumn("_parts", H.page_parts(F.when(is_html, raw)))
    cleaned = H.clean_body(raw, cleaner, builtin=F.col("_parts.text"))
    desc, text = F.col("_parts.description"), cleaned["text"]
    body = F.when((desc != "") & (F.instr(F.substring(text, 1, 500), desc) == 0),
                  F.concat(desc, F.lit("\n\n"), text)).otherwise(text)
    html_doc = F.struct(F.col("_parts.title").alias("title"), body.alias("body"), cleaned["cleaner"].alias("cleaner"),
                        desc.alias("description"))
    plain = F.struct(F.lit("").alias("title"), py_strip(raw).alias("body"), F.lit("plain_text").alias("cleaner"),
                     F.lit("").alias("description"))
    return df.withColumn(out, F.when(is_html, html_doc).otherwise(plain)).drop("_parts")


def ingest_pages(pages: DataFrame, url: str = "url", html: str = "html", method: str = "fetch",
                 cleaner: H.Cleaner | None = None, keep: list[str] | None = None) -> DataFrame:
    """Landed pages -> sources (``url, canonical_url, title, body, source_type,
    method, errors, metadata, cleaner``); a missing title becomes the URL."""
    keep = keep or []
    df = pages.select(*keep, F.col(url).alias("url"), canonical_url(F.col(url)).alias("canonical_url"),
                      F.col(html).alias("_html"))
    df = with_page_fields(df, "_html", cleaner=cleaner)
    return df.select(
        *keep, "url", "canonical_url",
        F.when(F.col("_p.title") != "", F.col("_p.title")).otherwise(F.col("canonical_url")).alias("title"),
        F.col("_p.body").alias("body"),
        F.lit("web").alias("source_type"),
        F.lit(method).alias("method"),
        empty_errors().alias("errors"),
        empty_meta().alias("metadata"),
        F.col("_p.cleaner").alias("cleaner"),
    )


def resolve_cache(requests: DataFrame, cache: DataFrame, fetched: DataFrame, refresh: bool = False,
                  feed: bool = False) -> DataFrame:
    """Serve requests from the fetch cache, fetch the misses.

    ``requests(url)`` are canonical URLs; ``cache(url_hash, title, text)`` is
    the cache table keyed by sha256(url); ``fetched(url, html)`` are landed
    fetch results.  Hits get method ``cache`` (``feed_cache``), misses or a
    refresh get ``fetch`` (``feed_fetch``) and their cache rows are emitted
    in ``cache_update``.  Returns ``(resolved, cache_update)``.
    """
    hit_m, miss_m = ("feed_cache", "feed_fetch") if feed else ("cache", "fetch")
    req = requests.select("url", cache_key(F.col("url")).alias("url_hash"))
    if refresh:
        hits = req.limit(0).join(cache, "url_hash", "inner")
        misses = req
    else:
        hits = req.join(cache, "url_hash", "inner")
        misses = req.join(cache.select("url_hash"), "url_hash", "left_anti")
    served = hits.select("url", "url_hash", F.col("title"), F.col("text"), F.lit(hit_m).alias("method"))
    fresh = misses.join(fetched.withColumnRenamed("url", "_fu"), F.col("url") == F.col("_fu"), "left")
    if feed:  # a feed is kept as it is: its reader needs the XML
        fields = F.struct(F.lit("").alias("title"), F.col("html").alias("body"), F.lit("none").alias("cleaner"))
    else:
        fresh = with_page_fields(fresh, "html")
        fields = F.col("_p")
    fresh = fresh.select("url", "url_hash", fields["title"].alias("title"), fields["body"].alias("text"),
                         F.when(F.col("html").isNull(), F.lit("fetch_failed")).otherwise(F.lit(miss_m))
                         .alias("method"), fields["cleaner"].alias("cleaner"))
    resolved = served.unionByName(fresh.drop("cleaner"))
    update = fresh.filter(F.col("method") == miss_m).select("url_hash", "url", "title", "text", "cleaner")
    return resolved, update
