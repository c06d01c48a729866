"""Scoring, status and rule columns (all JVM expressions)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from curation.functions.text import approx_tokens, let
from curation.functions.urls import domain

# Methods that count as a real extraction for the score.
STRONG_METHODS = ["fetch", "cache", "github_starred", "feed_fetch", "feed_cache"]
# Methods that always need manual follow-up.
MANUAL_METHODS = ["metadata_only", "fetch_failed"]
# Source lifecycle states in order.
LIFECYCLE_STATES = ["inbox", "extracted", "selected", "synthesized", "published"]


def domain_priority(url: Column, domains: Sequence[str]) -> Column:
    """Priority of the first listed domain that the host equals or is a
    sub-domain of: ``max(1, n - idx)``; 0 when none matches.

    The list is a small driver-side parameter, so it becomes one CASE
    expression (no join).  Large lists use ``operators.joins.domain_priority_join``.
    """
    host = domain(url)
    n = len(domains)
    expr = None
    for idx, d in enumerate(domains):
        d = d.lower()
        d = d[4:] if d.startswith("www.") else d
        cond = (host == d) | host.endswith("." + d)
        val = F.lit(max(1, n - idx))
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return F.lit(0) if expr is None else expr.otherwise(F.lit(0))


def quality_score(priority: Column, title: Column, body: Column, method: Column,
                  errors: Column) -> Column:
    """``max(0, 10*priority + min(40, len(body)//80) + 8*has_title
    + (12 if strong method else 2) - 20*has_errors)``."""
    char_score = F.least(F.lit(40), F.floor(F.length(F.coalesce(body, F.lit(""))) / 80).cast("int"))
    title_score = F.when(F.coalesce(title, F.lit("")) != "", 8).otherwise(0)
    method_score = F.when(method.isin(STRONG_METHODS), 12).otherwise(2)
    penalty = F.when(F.coalesce(F.size(errors), F.lit(0)) > 0, 20).otherwise(0)
    return F.greatest(F.lit(0), priority * 10 + char_score + title_score + method_score - penalty)


def score_sources(df, domains: Sequence[str]):
    """Add ``priority`` (max of own and domain), ``approx_tokens`` and
    ``quality_score`` to a sources DataFrame."""
    own = F.coalesce(F.col("priority"), F.lit(0)) if "priority" in df.columns else F.lit(0)
    df = df.withColumn("priority", F.greatest(own, domain_priority(F.col("canonical_url"), domains)))
    df = df.withColumn("approx_tokens", approx_tokens(F.col("title"), F.col("body")))
    return df.withColumn("quality_score", quality_score(F.col("priority"), F.col("title"), F.col("body"),
                                                        F.col("method"), F.col("errors")))


def needs_follow_up(method: Column, errors: Column) -> Column:
    return (F.coalesce(F.size(errors), F.lit(0)) > 0) | method.isin(MANUAL_METHODS)


def lifecycle_status(method: Column, errors: Column, body: Column, selected: Column) -> Column:
    """inbox (errors / manual method) > selected > extracted (has body) > inbox."""
    return (F.when(needs_follow_up(method, errors), "inbox")
            .when(selected, "selected")
            .when(F.coalesce(body, F.lit("")) != "", "extracted")
            .otherwise("inbox"))


def any_keyword(text: Column, words: Sequence[str]) -> Column:
    """True when the lower-cased text contains any of the words (the text is
    lower-cased once, also inside filters, which get no CSE)."""
    def hit(low: Column) -> Column:
        cond = F.lit(False)
        for w in words:
            cond = cond | (F.instr(low, w.lower()) > 0)
        return cond
    return let(F.lower(text), hit)
