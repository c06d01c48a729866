"""Link ingestion from explicit lists, free text and manual sources,
order preserved, duplicates kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curation.functions.text import SPACE

# Python ``\s`` (Unicode) inside the excluded set, as the reference pattern.
URL_RE = "https?://[^" + SPACE[1:-1] + "<>'\")\\]]+"
TRAILING = "[.,;:!?]+$"


def extract_urls(text: Column) -> Column:
    """array of URLs found in the text, trailing ``.,;:!?`` removed."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(URL_RE), 0)
    return F.transform(found, lambda u: F.regexp_replace(u, TRAILING, ""))


def ingest_links(explicit: DataFrame | None = None, texts: DataFrame | None = None,
                 manual: DataFrame | None = None, key: str = "run") -> DataFrame:
    """Links of a run in order: explicit list (rank 0), then URLs found in
    the input texts (rank 1), then manual sources (rank 2).

    ``explicit(key, links array)``, ``texts(key, text)``,
    ``manual(key, pos, url)`` -> ``(key, src_rank, pos, url)``.
    """
    parts = []
    if explicit is not None:
        parts.append(explicit.select(key, F.lit(0).alias("src_rank"), F.posexplode("links").alias("pos", "url")))
    if texts is not None:
        parts.append(texts.select(key, F.lit(1).alias("src_rank"),
                                  F.posexplode(extract_urls(F.col("text"))).alias("pos", "url")))
    if manual is not None:
        m = manual.filter(F.coalesce(F.col("url"), F.lit("")) != "")
        parts.append(m.select(key, F.lit(2).alias("src_rank"), "pos", "url"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
