"""Digest run: sources -> score -> dedupe -> budget -> manifest / digest.

Scoring runs where the page is read, dedupe and selection move only narrow
rows, and bodies are re-attached for the selected rows alone (at most
``budget`` keys).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curation.functions.scoring import lifecycle_status, score_sources
from curation.functions.urls import source_id
from curation.operators.budget import select_for_budget
from curation.operators.dedupe import dedupe_best
from curation.session import materialize

# Defaults of a digest run (token budget, per-source cap).
DEFAULT_BUDGET = 4000
DEFAULT_PER_SOURCE = 900

NARROW = ["ordinal", "canonical_url", "title", "source_type", "method", "errors", "metadata", "priority",
          "quality_score", "approx_tokens"]


def scored(sources: DataFrame, domains: Sequence[str]) -> DataFrame:
    """E9/E11/J1 on a sources DataFrame (needs ``ordinal`` for ties)."""
    return score_sources(sources, domains)


def best_sources(sources: DataFrame, domains: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Scored, narrow, one row per canonical URL (A1)."""
    s = scored(sources, domains)
    s = s.withColumn("has_body", F.coalesce(F.col("body"), F.lit("")) != "")
    cols = list(dict.fromkeys(NARROW + ["has_body"] + list(extra)))
    return dedupe_best(s.select(*cols))


def run_selection(sources: DataFrame, domains: Sequence[str], budget: int = DEFAULT_BUDGET,
                  per_source: int = DEFAULT_PER_SOURCE, extra: Sequence[str] = ()) -> DataFrame:
    """Every deduped source with ``selected``, ``selected_tokens``, ``status``
    and the 16-hex state ``id``."""
    # The deduped narrow table is read twice (candidates and the join back);
    # writing it once keeps the page extraction to a single pass.
    best = materialize(best_sources(sources, domains, extra))
    sel = select_for_budget(best, budget, per_source)
    body_flag = F.when(F.col("has_body"), F.lit("x")).otherwise(F.lit(""))
    return (sel.withColumn("status", lifecycle_status(F.col("method"), F.col("errors"), body_flag,
                                                      F.col("selected")))
            .withColumn("id", source_id(F.col("canonical_url"))))


def run_digest(sources: DataFrame, domains: Sequence[str], warnings: DataFrame, budget: int = DEFAULT_BUDGET,
               per_source: int = DEFAULT_PER_SOURCE, key: str = "ordinal", raw: DataFrame | None = None,
               extract=None):
    """Selection + digest lines of one run.  The narrow selection feeds five
    digest sections, so it is materialised once (reliable checkpoint).

    With ``raw`` (un-extracted rows keyed by ``key``) and ``extract`` (raw ->
    sources), bodies are extracted only for the selected rows."""
    from curation.plans.digest import digest_lines
    sel = materialize(run_selection(sources, domains, budget, per_source))
    bodies = attach_bodies(sel, sources, budget, key, raw=raw, extract=extract).select("canonical_url", "body")
    return sel, digest_lines(sel, bodies, warnings, budget)


def arrival(family: int, part: Column, pos: Column) -> Column:
    """Arrival order as a struct: family of inputs (links, starred repos,
    feeds), place of the page or feed in it, place of the item in that."""
    return F.struct(F.lit(family).alias("family"), part.cast("long").alias("part"), pos.cast("long").alias("pos"))


def attach_bodies(selection: DataFrame, sources: DataFrame, budget: int,
                  key: str = "ordinal", raw: DataFrame | None = None, extract=None) -> DataFrame:
    """Bodies for the selected rows only, by a semi-join on ``key`` with at
    most ``budget`` keys (AQE broadcasts them when they are few).  Given ``raw``
    and ``extract``, the semi-join runs on the raw rows first, so the
    (expensive) extraction touches the selected rows alone."""
    picked = selection.filter("selected").select(key)
    if raw is not None and extract is not None:
        bodies = extract(raw.join(picked, key, "left_semi")).select(key, "body")
    else:
        # an inner join on distinct keys: Spark 4.1 fails to push a semi-join
        # into a union one of whose inputs is empty
        bodies = sources.join(picked.distinct(), key).select(key, "body")
    return selection.filter("selected").join(bodies, key, "left")


def collect_sources(links: DataFrame, landed: DataFrame, manual: DataFrame | None = None,
                    feed_sources: DataFrame | None = None, star_sources: DataFrame | None = None) -> DataFrame:
    """U1 for one run: links (in order) -> social posts (S9, manual text)
    or landed pages (S8; a link without a landed page is ``fetch_failed``
    unless manual text exists), then starred repos, then feed items.

    ``links(pos, url)``; ``landed(url, html)`` keyed by fetched URL;
    ``manual(url, text)``; ``feed_sources`` / ``star_sources`` in the
    sources schema with ``pos`` and, if items of several pages or feeds are
    in it, ``page_no`` or ``feed_id``.  Returns sources with ``ordinal``.
    """
    from curation.functions.text import py_strip
    from curation.functions.urls import canonical_url, is_x_url
    from curation.operators.records import attach_manual_text, short_post_sources
    from curation.sources.pages import ingest_pages

    spark = links.sparkSession
    manual = manual if manual is not None else spark.createDataFrame([], "url string, text string")
    lk = attach_manual_text(links, manual).withColumn("canonical_url", canonical_url(F.col("url")))
    social = short_post_sources(lk.filter(is_x_url(F.col("canonical_url"))).drop("canonical_url"), keep=["pos"])
    web = lk.filter(~is_x_url(F.col("canonical_url")))
    # one landing of a canonical URL: that of the smallest fetched URL
    landed = (landed.groupBy(canonical_url(F.col("url")).alias("_can"))
              .agg(F.min(F.struct("url", "html")).alias("l")).select("_can", "l.url", "l.html"))
    pages = ingest_pages(landed, keep=["_can"]) \
        .drop("url", "canonical_url")
    web = web.join(pages, web["canonical_url"] == pages["_can"], "left").drop("_can")
    failed = F.col("body").isNull()
    has_manual = F.col("manual_text") != ""
    web = web.select(
        "pos", "url", "canonical_url",
        F.when(failed, F.col("canonical_url")).otherwise(F.col("title")).alias("title"),
        F.when(failed & has_manual, py_strip(F.col("manual_text"))).otherwise(F.coalesce("body", F.lit("")))
        .alias("body"),
        F.lit("web").alias("source_type"),
        F.when(failed & has_manual, "manual_text").when(failed, "fetch_failed").otherwise(F.col("method"))
        .alias("method"),
        F.when(failed, F.array(F.lit("fetch_failed: page not landed"))).otherwise(F.col("errors")).alias("errors"),
        F.coalesce("metadata", F.create_map().cast("map<string,string>")).alias("metadata"))
    out = web.unionByName(social, allowMissingColumns=True).withColumn("ordinal", arrival(0, F.lit(0), F.col("pos")))
    for family, part, extra in ((1, "page_no", star_sources), (2, "feed_id", feed_sources)):
        if extra is not None:
            place = F.col(part) if part in extra.columns else F.lit(0)
            e = extra.withColumn("ordinal", arrival(family, place, F.col("pos")))
            out = out.unionByName(e, allowMissingColumns=True)
    if "priority" not in out.columns:
        out = out.withColumn("priority", F.lit(0))
    return out.withColumn("priority", F.coalesce("priority", F.lit(0)))
