"""Markdown notes with front matter, and the corpus lint jobs
(E20 missing fields, A4 duplicate URLs, A5 summary, J8 unsynthesised raw
notes, W7 bounded samples)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curation.functions.scoring import any_keyword
from curation.functions.text import LINE_BREAK_SEQ, SPACE, let, py_strip
from curation.session import materialize

# Front-matter fields every source note must carry.
REQUIRED_SOURCE_FIELDS = ["title", "source_url", "source_type", "captured_at", "status"]
# Promote keywords of the lint.
PROMOTE_KEYWORDS = ["obsidian", "wiki", "agent", "context", "codex", "claude", "eval", "pipeline"]
# Folder layers of the vault.
SOURCE_LAYER = "/20_Sources/"
RAW_LAYER = "/10_Raw/"
SYNTHESIS_LAYER = "/50_Synthesis/"
SAMPLE_LIMIT = 20
DUPLICATE_SAMPLE = 5

FRONT_MATTER_RE = "(?s)^---\n(.*?)\n---"
# Python ``\s`` as a class body (no brackets) for use inside other classes.
_SPACE_BODY = SPACE[1:-1]
LINT_URL_RE = f"https?://[^{_SPACE_BODY})>'\"]+"


def read_notes(spark: SparkSession, path_glob: str) -> DataFrame:
    """Markdown files as ``notes(path, md)``, one row per whole file."""
    raw = spark.read.text(path_glob, wholetext=True)
    # paths come percent-encoded; a plus sign in a name is no blank
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return raw.select(path.alias("path"), F.regexp_replace("value", "\r\n?", "\n").alias("md"))


def front_matter(md: Column) -> Column:
    """``map<string,string>`` of the leading ``---`` block: ``k: v`` lines
    split at the first colon, both sides stripped, quotes stripped from the
    value; a later duplicate key wins.  Empty map without a block."""
    block = F.regexp_extract(md, FRONT_MATTER_RE, 1)
    hit = F.regexp_extract(md, FRONT_MATTER_RE, 0) != ""
    lines = F.filter(F.split(block, LINE_BREAK_SEQ), lambda x: F.instr(x, ":") > 0)
    entries = F.transform(lines, lambda x: F.struct(
        py_strip(F.substring_index(x, ":", 1)).alias("k"),
        F.regexp_replace(py_strip(F.substring(x, F.instr(x, ":") + 1, F.lit(1 << 30))), '^"+|"+$', "").alias("v")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries), F.lit(1))),
                                                    lambda o: o["k"] == e["k"]))
    fm = F.map_from_entries(last)
    return F.when(hit, fm).otherwise(F.create_map().cast("map<string,string>"))


def ingest_notes(notes: DataFrame) -> DataFrame:
    """Adds ``fm``, ``name`` and the layer flags to ``notes(path, md)``."""
    return notes.select(
        "path", "md", front_matter(F.col("md")).alias("fm"),
        F.element_at(F.split("path", "/"), -1).alias("name"),
        (F.instr("path", SOURCE_LAYER) > 0).alias("is_source"),
        (F.instr("path", RAW_LAYER) > 0).alias("is_raw"),
        (F.instr("path", SYNTHESIS_LAYER) > 0).alias("is_synthesis"),
    )


def absent_fields(fm: Column, required: Sequence[str] = REQUIRED_SOURCE_FIELDS) -> Column:
    """The required fields that a front matter lacks or leaves empty."""
    req = F.array(*[F.lit(f) for f in required])
    # The map is bound once; a plain reference inside the lambda would be
    # re-evaluated for every required field.
    return let(fm, lambda m: F.filter(req, lambda f: F.coalesce(m[f], F.lit("")) == ""))


def missing_fields(notes: DataFrame, required: Sequence[str] = REQUIRED_SOURCE_FIELDS) -> DataFrame:
    """Source notes with required fields absent or empty."""
    return (notes.filter("is_source").select("path", absent_fields(F.col("fm"), required).alias("missing"))
            .filter(F.size("missing") > 0))


def promotes(fm: Column, md: Column, words: Sequence[str] = PROMOTE_KEYWORDS) -> Column:
    """E19 on a note: title + text hits a promote keyword."""
    return any_keyword(F.concat(F.coalesce(fm["title"], F.lit("")), F.lit(" "), md), words)


def note_urls(md: Column) -> Column:
    """The distinct URLs of a note (own pattern, ``.,`` right-stripped)."""
    return F.array_distinct(F.transform(F.regexp_extract_all(md, F.lit(LINT_URL_RE), 0),
                                        lambda u: F.regexp_replace(u, "[.,]+$", "")))


def duplicate_urls(notes: DataFrame, sample: int = DUPLICATE_SAMPLE) -> DataFrame:
    """A4: URLs that occur in more than one distinct note, with the count and
    the first ``sample`` paths (a hot URL never collects all its notes)."""
    pairs = notes.select("path", F.explode(note_urls(F.col("md"))).alias("url")).distinct()
    counts = pairs.groupBy("url").agg(F.count("*").alias("n_notes")).filter(F.col("n_notes") > 1)
    w = Window.partitionBy("url").orderBy("path")
    first = (pairs.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= F.lit(sample))
             .groupBy("url").agg(F.array_sort(F.collect_list("path")).alias("paths")))
    return counts.join(first, "url")


def unsynthesised(notes: DataFrame) -> DataFrame:
    """Raw notes whose file name occurs in no synthesis note.

    Every name ends in ``.md``, so a name occurs in a text exactly when it
    ends at some ``.md`` occurrence.  One pass over the texts gives the
    candidates of ``named``; they are equi-joined to the names (no
    nested-loop join).
    """
    synth = notes.filter("is_synthesis").select("md", raw_name_shape(notes).alias("shape"))
    found = synth.select(F.explode(named(F.col("md"), F.col("shape"))).alias("name"))
    return notes.filter("is_raw").select("path", "name").join(found.distinct(), "name", "left_anti").select("path")


def raw_name_shape(notes: DataFrame) -> Column:
    """struct(lengths, inner) of the raw notes' names as a scalar subquery:
    their distinct lengths (as many as the longest file name at most) and the
    largest number of ``.md`` inside a name before its end."""
    names = notes.filter(F.col("is_raw") & F.col("name").endswith(".md")).select("name")
    return names.agg(F.struct(
        F.collect_set(F.length("name")).alias("lengths"),
        F.coalesce(F.max(F.size(F.split("name", r"\.md")) - 2), F.lit(0)).alias("inner"))).scalar()


def named(md: Column, shape: Column) -> Column:
    """The distinct substrings of ``md`` that end in ``.md`` and have one of
    the lengths of ``shape``.  The text is cut at every ``.md``; what a name
    that ends there can reach lies in the piece before it and in ``inner``
    further ones."""
    def before(pieces, inner):
        return F.transform(F.sequence(F.lit(1), F.size(pieces) - 1), lambda i: F.concat(
            F.array_join(F.slice(pieces, F.greatest(F.lit(1), i - inner), F.least(i, inner + 1)), ".md"),
            F.lit(".md")))

    def tails(s, pieces):
        return F.array_distinct(F.flatten(F.transform(
            before(pieces, s["inner"]),
            lambda t: F.transform(F.filter(s["lengths"], lambda n: n <= F.length(t)), lambda n: F.right(t, n)))))

    pieces = F.split(md, r"\.md")
    return F.when(F.contains(md, F.lit(".md")), let(shape, lambda s: let(pieces, lambda p: tails(s, p)))) \
        .otherwise(F.array().cast("array<string>"))


def lint_summary(notes: DataFrame) -> DataFrame:
    """Counts, issue counts, ok flag and bounded, path-sorted samples
    (one row; every part is an aggregate or a top-k).  The texts are read
    once, for one narrow row per note that is written and serves all parts."""
    fm, md = F.col("fm"), F.col("md")
    facts = materialize(notes.withColumn("shape", raw_name_shape(notes)).select(
        "path", "name", "is_source", "is_raw",
        (F.col("is_source") & (F.size(absent_fields(fm)) > 0)).alias("lacks"),
        (F.col("is_source") & promotes(fm, md)).alias("promotes"), note_urls(md).alias("urls"),
        F.when(F.col("is_synthesis"), named(md, F.col("shape"))).alias("named")))
    counts = facts.agg(F.count("*").alias("total_notes"), F.count_if("is_source").alias("source_notes"),
                       F.count_if("is_raw").alias("raw_notes"), F.count_if("lacks").alias("missing_frontmatter"))
    dups = (facts.select("path", F.explode("urls").alias("url")).distinct().groupBy("url").count()
            .filter(F.col("count") > 1))
    dup = dups.agg(F.count("*").alias("duplicate_urls"))
    found = facts.select(F.explode("named").alias("name")).distinct()
    left = facts.filter("is_raw").join(found, "name", "left_anti")
    # Bounded samples: a top-k first, so each list holds at most k values.
    dup_sample = dups.select("url").orderBy("url").limit(DUPLICATE_SAMPLE).agg(
        F.array_sort(F.collect_list("url")).alias("duplicate_sample"))
    promote = facts.filter("promotes").select("path").orderBy("path").limit(SAMPLE_LIMIT).agg(
        F.array_sort(F.collect_list("path")).alias("promote"))
    unsyn = left.select("path").orderBy("path").limit(SAMPLE_LIMIT).agg(
        F.array_sort(F.collect_list("path")).alias("unsynthesised"))
    one = counts
    for other in (dup, dup_sample, promote, unsyn):
        one = one.unionByName(other, allowMissingColumns=True)
    out = one.agg(*[F.max(c).alias(c) for c in ["total_notes", "source_notes", "raw_notes",
                                                  "missing_frontmatter", "duplicate_urls"]],
                  F.first("duplicate_sample", ignorenulls=True).alias("duplicate_sample"),
                  F.first("promote", ignorenulls=True).alias("promote"),
                  F.first("unsynthesised", ignorenulls=True).alias("unsynthesised"))
    return out.withColumn("ok", (F.col("missing_frontmatter") == 0) & (F.col("duplicate_urls") == 0))
