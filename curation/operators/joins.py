"""Join forms of rules whose parameter list can grow large.

J1 with a large domain list: instead of a theta join (host equals or ends
with ``.domain`` -- a nested loop), every host is expanded into its dot
suffixes and equi-joined to the list, then the smallest index wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curation.functions.urls import domain


def host_suffixes(host: Column) -> Column:
    """``a.b.c`` -> ``[a.b.c, b.c, c]`` (the host and every dot suffix)."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(parts, i, n - i + 1), "."))


def normalise_domains(domains: DataFrame) -> DataFrame:
    """``domains(domain, idx)`` lower-cased, one leading ``www.`` removed."""
    return domains.select(F.regexp_replace(F.lower("domain"), r"^www\.", "").alias("domain"), "idx")


def domain_priority_join(df: DataFrame, url: str, domains: DataFrame, out: str = "priority") -> DataFrame:
    """J1 as an equi-join: priority ``max(1, n - idx)`` of the first listed
    domain the URL's host equals or is a sub-domain of, else 0.

    Every row of ``df`` is kept; the suffix expansion runs once per
    distinct host.
    """
    d = normalise_domains(domains)
    n_domains = d.agg(F.count("*")).scalar()
    best = d.groupBy("domain").agg(F.min("idx").alias("idx"))
    # Priority depends on the host only: resolve each distinct host once.
    with_host = df.withColumn("_host", domain(F.col(url)))
    hosts = with_host.select("_host").distinct()
    sfx = hosts.select("_host", F.explode(host_suffixes(F.col("_host"))).alias("domain"))
    hits = sfx.join(best, "domain").groupBy("_host").agg(F.min("idx").alias("_idx"))
    res = with_host.join(hits, "_host", "left")
    pr = F.when(F.col("_idx").isNull(), F.lit(0)).otherwise(F.greatest(F.lit(1), n_domains - F.col("_idx")))
    return res.withColumn(out, pr.cast("int")).drop("_host", "_idx")
