"""Digest-run outputs: budget summary (A2), run report (A3), state manifest
(K1, U3, J7, E13), digest lines (K2), digest parsing (S13) and latest
source state across runs (T4).

The digest is produced as ordered rows ``(section, part, grp, nq, np, url,
sub, line)`` -- the sort key is part of the row, so the skipped-source
section (which grows with the input) never has to be gathered into one
string or one task.  Only the selected items (bounded by the budget) are
ever assembled into a single document.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curation.functions.scoring import needs_follow_up
from curation.functions.text import excerpt, py_strip
from curation.session import materialize, path_exists

NO_BODY = "(No extracted body. Add manual text in config.)"
FOLLOW_UP = ": add full text, screenshots, transcript, or corrected URL."
LINE_COLS = ["section", "part", "grp", "nq", "np", "url", "sub", "line"]


def budget_summary(sel: DataFrame, budget: int) -> DataFrame:
    """A2: candidate / selected / remaining tokens and counts (one row)."""
    return sel.agg(
        F.lit(budget).alias("budget"),
        F.coalesce(F.sum("approx_tokens"), F.lit(0)).cast("long").alias("candidate_tokens"),
        F.coalesce(F.sum("selected_tokens"), F.lit(0)).cast("long").alias("selected_tokens"),
        F.greatest(F.lit(0), F.lit(budget) - F.coalesce(F.sum("selected_tokens"), F.lit(0))).cast("long")
        .alias("remaining_tokens"),
        F.count_if("selected").alias("selected_sources"),
        F.count_if(~F.col("selected")).alias("skipped_sources"),
    )


def run_report(sel: DataFrame, warnings: DataFrame, run_id: str) -> DataFrame:
    """A3: run report (one row); ``warnings(idx, warning)`` is small."""
    w = warnings.orderBy("idx").agg(F.collect_list("warning").alias("warnings"))
    s = sel.agg(F.count("*").alias("candidate_sources"), F.count_if("selected").alias("selected_sources"),
                F.count_if(~F.col("selected")).alias("skipped_sources"),
                F.coalesce(F.sum("selected_tokens"), F.lit(0)).cast("long").alias("selected_tokens"))
    both = s.unionByName(w, allowMissingColumns=True)
    return both.agg(F.lit(True).alias("ok"), F.lit(run_id).alias("run_id"),
                    *[F.max(c).alias(c) for c in ["candidate_sources", "selected_sources", "skipped_sources",
                                                  "selected_tokens"]],
                    F.coalesce(F.first("warnings", ignorenulls=True), F.array().cast("array<string>"))
                    .alias("warnings"))


def state_manifest(sel: DataFrame, run_id: str, seen_at: Column) -> DataFrame:
    """K1: one state item per source (selected + skipped)."""
    return sel.select(
        "id", F.lit(run_id).alias("run_id"), "status", "canonical_url", "title", "source_type", "method",
        "quality_score", "approx_tokens", "selected_tokens", "errors",
        (F.col("metadata") if "metadata" in sel.columns else F.create_map().cast("map<string,string>"))
        .alias("metadata"),
        seen_at.alias("last_seen_at"))


def write_state_manifest(manifest: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write one run's items to the state log, partitioned by run; a repeated
    run replaces its own items."""
    (manifest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id")
     .format(fmt).save(path))


def latest_state(manifests: DataFrame, published: DataFrame | None = None) -> DataFrame:
    """T4: newest item per id across runs; ids already published can be
    gated out with a left-anti join."""
    w = Window.partitionBy("id").orderBy(F.col("last_seen_at").desc(), F.col("run_id").desc())
    latest = manifests.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r")
    if published is not None:
        latest = latest.join(published.select("id"), "id", "left_anti")
    return latest


def merge_snapshot(spark: SparkSession, path: str, manifest: DataFrame, buckets: int = 64) -> None:
    """T4 kept up to date: merges one run's items into the snapshot at
    ``path``, which holds the newest item of each id, in buckets of ids.

    Reads the run and the buckets that its ids fall in, and replaces these
    alone; the history is never read again.  A repeated run changes nothing."""
    new = materialize(manifest.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")))
    touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
    rows = new
    if path_exists(spark, path):
        rows = new.unionByName(spark.read.schema(new.schema).parquet(path).filter(F.col("bucket").isin(touched)))
    newest = rows.groupBy("bucket", "id").agg(
        F.max_by(F.struct(*(c for c in manifest.columns if c != "id")), F.struct("last_seen_at", "run_id")).alias("s"))
    # written once before the buckets that it was read from are replaced
    newest = materialize(newest.select("id", "s.*", "bucket"))
    (newest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path))


def unpublished(spark: SparkSession, path: str, published: DataFrame) -> DataFrame:
    """The publish gate: the snapshot's items that were not published yet."""
    return spark.read.parquet(path).drop("bucket").join(published.select("id").distinct(), "id", "left_anti")


def _lines(section: int, part: int, lines: Sequence[Column] | Column, grp=None, q=None, p=None,
           url=None) -> list[Column]:
    arr = lines if isinstance(lines, Column) else F.array(*lines)
    return [F.lit(section).alias("section"), F.lit(part).alias("part"),
            (grp if grp is not None else F.lit(None).cast("int")).alias("grp"),
            (-q if q is not None else F.lit(None).cast("int")).alias("nq"),
            (-p if p is not None else F.lit(None).cast("int")).alias("np"),
            (url if url is not None else F.lit(None).cast("string")).alias("url"),
            F.posexplode(F.filter(arr, lambda x: x.isNotNull())).alias("sub", "line")]


def digest_lines(sel: DataFrame, bodies: DataFrame, warnings: DataFrame, budget: int) -> DataFrame:
    """K2: every line of the Markdown digest as an ordered row.

    ``sel`` is the full selection (all candidates); ``bodies(canonical_url,
    body)`` covers the selected rows only; ``warnings(idx, warning)``.
    """
    spark = sel.sparkSession
    summ = budget_summary(sel, budget)
    head = summ.select(*_lines(0, 0, [
        F.lit("# Local Source Digest"), F.lit(""), F.lit("## Token Budget"),
        F.concat(F.lit("- Budget: "), F.col("budget")),
        F.concat(F.lit("- Candidate approx tokens: "), F.col("candidate_tokens")),
        F.concat(F.lit("- Selected approx tokens: "), F.col("selected_tokens")),
        F.concat(F.lit("- Remaining approx tokens: "), F.col("remaining_tokens")),
        F.concat(F.lit("- Selected sources: "), F.col("selected_sources")),
        F.concat(F.lit("- Skipped sources: "), F.col("skipped_sources")), F.lit("")]))
    wcount = warnings.agg(F.count("*").alias("n"))
    whead = wcount.filter("n > 0").select(*_lines(1, 0, [F.lit("## Warnings")]))
    wrows = warnings.select(*_lines(1, 1, [F.concat(F.lit("- "), F.col("warning"))], grp=F.col("idx").cast("int")))
    wtail = wcount.filter("n > 0").select(*_lines(1, 2, [F.lit("")]))

    one = spark.range(1)
    phead = one.select(*_lines(2, 0, [F.lit("## Priority Sources")]))
    # The walk numbers its picks in rank order, so no global window is needed.
    picked = sel.filter("selected").join(bodies, "canonical_url", "left").withColumn("_rank", F.col("pick_rank"))
    meta = F.col("metadata") if "metadata" in picked.columns else F.create_map().cast("map<string,string>")
    state = F.when(needs_follow_up(F.col("method"), F.col("errors")), "inbox").otherwise("selected")
    ex = excerpt(F.col("body"), F.col("selected_tokens"))
    item = [
        F.concat(F.lit("### "), F.col("_rank"), F.lit(". "),
                 F.when(F.coalesce("title", F.lit("")) != "", F.col("title")).otherwise(F.col("canonical_url"))),
        F.concat(F.lit("- URL: "), F.col("canonical_url")),
        F.concat(F.lit("- Type: "), F.col("source_type")),
        F.concat(F.lit("- Method: "), F.when(F.coalesce("method", F.lit("")) != "", F.col("method"))
                 .otherwise(F.lit("(none)"))),
        F.concat(F.lit("- State: "), state),
        F.concat(F.lit("- Quality score: "), F.col("quality_score")),
        F.concat(F.lit("- Approx tokens used: "), F.col("selected_tokens")),
        F.when(F.coalesce(meta["manual_fallback"], F.lit("")) != "",
               F.concat(F.lit("- Manual fallback: "), meta["manual_fallback"])),
        F.when(F.coalesce(F.size("errors"), F.lit(0)) > 0,
               F.concat(F.lit("- Needs attention: "), F.array_join("errors", "; "))),
        F.lit(""), F.when(ex != "", ex).otherwise(F.lit(NO_BODY)), F.lit(""),
    ]
    prows = picked.select(*_lines(2, 1, item, q=F.col("quality_score"), p=F.col("priority"),
                                  url=F.col("canonical_url")))

    skipped = sel.filter(~F.col("selected"))
    scount = skipped.agg(F.count("*").alias("n"))
    shead = scount.filter("n > 0").select(*_lines(3, 0, [F.lit("## Skipped Due To Budget")]))
    srows = skipped.select(*_lines(3, 1, [F.concat(F.lit("- score="), F.col("quality_score"), F.lit(" tokens="),
                                                   F.col("approx_tokens"), F.lit(" "), F.col("canonical_url"))],
                                   q=F.col("quality_score"), p=F.col("priority"), url=F.col("canonical_url")))
    stail = scount.filter("n > 0").select(*_lines(3, 2, [F.lit("")]))

    manual = sel.filter(needs_follow_up(F.col("method"), F.col("errors")))
    mcount = manual.agg(F.count("*").alias("n"))
    mhead = one.select(*_lines(4, 0, [F.lit("## Manual Follow-Up")]))
    mrows = manual.select(*_lines(4, 1, [F.concat(F.lit("- "), F.col("canonical_url"), F.lit(FOLLOW_UP))],
                                  grp=F.when(F.col("selected"), 0).otherwise(1), q=F.col("quality_score"),
                                  p=F.col("priority"), url=F.col("canonical_url")))
    mnone = mcount.filter("n = 0").select(*_lines(4, 1, [F.lit("- None")]))
    mtail = one.select(*_lines(4, 2, [F.lit("")]))

    out = head
    for d in (whead, wrows, wtail, phead, prows, shead, srows, stail, mhead, mrows, mnone, mtail):
        out = out.unionByName(d)
    return out


def digest_order() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in LINE_COLS[:-1]]


def write_digest(lines: DataFrame, path: str) -> None:
    """K2: the digest as text files whose names and lines stand in its order:
    rows are dealt by ranges of that order, so the skipped sources and the
    warnings, which grow with the input, fill many files."""
    order = digest_order()
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select("line").write.mode("overwrite").text(path)


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """``(no, line)``: the lines of a written digest, numbered from 1.

    A line's number is its place in its piece of a file, plus the lines of the
    pieces before: one row a piece, summed up."""
    rows = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("line"))
    pieces = rows.groupBy("file", "at").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy(F.lit(1)).orderBy("file", "at").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return rows.join(pieces, ["file", "at"]).select((F.col("before") + F.col("place") - F.col("first") + 1).alias("no"), "line")


def selected_digest_document(lines: DataFrame) -> DataFrame:
    """Header and selected items as one Markdown document (bounded by the
    budget: at most ``budget`` items)."""
    bounded = lines.filter(F.col("section").isin(0, 2))  # warnings have no bound
    parts = F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in LINE_COLS])))
    return bounded.agg(F.array_join(F.transform(parts, lambda x: x["line"]), "\n").alias("md"))


ITEM_BLOCK_RE = r"(?md)^###\s+\d+\.\s+.+$[\s\S]*?(?=^###\s+\d+\.\s+.+$|\z)"


def parse_digest(docs: DataFrame) -> DataFrame:
    """``docs(md)`` -> one row per ``### N. title`` block with URL, type,
    score and a 240-char body (lines starting with ``-`` or ``#`` dropped)."""
    blocks = docs.select(F.posexplode(F.regexp_extract_all("md", F.lit(ITEM_BLOCK_RE), 0)).alias("pos", "block"))
    title = py_strip(F.regexp_extract("block", r"(?md)^###\s+\d+\.\s+(.+)$", 1))
    url = py_strip(F.regexp_extract("block", r"(?md)^- URL:\s+(.+)$", 1))
    typ = py_strip(F.regexp_extract("block", r"(?md)^- Type:\s+(.+)$", 1))
    score_s = F.regexp_extract("block", r"(?md)^- Quality score:\s+(\d+)", 1)
    score = F.when(score_s != "", score_s.cast("int")).otherwise(F.lit(0))
    body = py_strip(F.regexp_replace("block", r"(?md)^[-#].*$", ""))
    body = F.regexp_replace(body, "\n{2,}", "\n")
    return blocks.select("pos", title.alias("title"), url.alias("url"), typ.alias("type"), score.alias("score"),
                         F.substring(body, 1, 240).alias("body"))
