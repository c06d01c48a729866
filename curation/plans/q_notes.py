"""Registered lint queries: documents rendered as a note vault with front
matter (stand-in input), then S12 / E20 / A4 / J8 / A5 / W7 on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curation.functions.text import LINE_BREAK_SEQ
from curation.plans import sqlgen as S
from curation.plans.registry import register
from curation.session import read_table
from curation.sources import notes as N

VAULT = "/vault/"


def vault_notes(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as notes: layer by source number, front matter with some
    fields left out or empty, synthesis notes naming other notes."""
    d = read_table(spark, sf, "documents")
    n = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    layer = (F.when(n <= 5, "20_Sources").when(n <= 9, "10_Raw").when(n <= 12, "50_Synthesis")
             .otherwise("30_Concepts"))
    first = F.replace(F.substring_index("text", "\n", 1), F.lit('"'), F.lit(""))
    title = F.when(F.col("lang") == "es", F.lit("")).otherwise(first)
    fm = F.concat(F.lit('---\ntitle: "'), title, F.lit('"\nsource_url: https://news.example.com/'), F.col("lang"),
                  F.lit("/"), F.col("source"), F.lit("\nsource_type: article\ncaptured_at: 2024-01-31"),
                  F.when(F.col("lang") != "de", F.lit("\nstatus: inbox")).otherwise(F.lit("")), F.lit("\n---\n"))
    tail = F.when(layer == "50_Synthesis",
                  F.concat(F.lit("\n\nRaw: note-"), (F.col("doc_id") - 1).cast("string"),
                           F.lit(".md, see also note-"), (F.col("doc_id") + 1).cast("string"))).otherwise(F.lit(""))
    path = F.concat(F.lit(VAULT), layer, F.lit("/"), F.col("lang"), F.lit("/note-"), F.col("doc_id"), F.lit(".md"))
    return N.ingest_notes(d.select(path.alias("path"), F.concat(fm, F.col("text"), tail).alias("md")))


def _rel(c):
    return F.regexp_replace(c, "^" + VAULT, "")


_NOTES_SQL = f"""nts AS (
  SELECT '{VAULT}' || layer || '/' || lang || '/note-' || doc_id || '.md' AS path,
         '---' || chr(10) || 'title: "' || (CASE WHEN lang = 'es' THEN '' ELSE replace(split_part(text, chr(10), 1), '"', '') END)
         || '"' || chr(10) || 'source_url: https://news.example.com/' || lang || '/' || source || chr(10)
         || 'source_type: article' || chr(10) || 'captured_at: 2024-01-31'
         || (CASE WHEN lang <> 'de' THEN chr(10) || 'status: inbox' ELSE '' END) || chr(10) || '---' || chr(10)
         || text || (CASE WHEN layer = '50_Synthesis' THEN chr(10) || chr(10) || 'Raw: note-' || (doc_id - 1)
                     || '.md, see also note-' || (doc_id + 1) ELSE '' END) AS md
  FROM (SELECT *, CASE WHEN n <= 5 THEN '20_Sources' WHEN n <= 9 THEN '10_Raw' WHEN n <= 12 THEN '50_Synthesis'
                       ELSE '30_Concepts' END AS layer
        FROM (SELECT *, CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) AS n FROM documents))),
notes AS (
  SELECT path, md, string_split(path, '/')[-1] AS name,
         strpos(path, '/20_Sources/') > 0 AS is_source, strpos(path, '/10_Raw/') > 0 AS is_raw,
         strpos(path, '/50_Synthesis/') > 0 AS is_synthesis,
         CASE WHEN regexp_matches(md, {S.q(N.FRONT_MATTER_RE)}) THEN
           list_transform(list_filter(regexp_split_to_array(regexp_extract(md, {S.q(N.FRONT_MATTER_RE)}, 1), {S.q(LINE_BREAK_SEQ)}),
                                      lambda x: strpos(x, ':') > 0),
                          lambda x: struct_pack(k := {S.strip("split_part(x, ':', 1)")},
                                                v := regexp_replace({S.strip("substr(x, strpos(x, ':') + 1)")}, '^"+|"+$', '', 'g')))
         ELSE [] END AS entries
  FROM nts),
fields AS (
  SELECT *, {", ".join(f"coalesce(list_filter(entries, lambda e: e.k = '{f}')[-1].v, '') AS f_{f}" for f in N.REQUIRED_SOURCE_FIELDS)}
  FROM notes),
urls AS (SELECT DISTINCT path, regexp_replace(u, '[.,]+$', '') AS url
         FROM (SELECT path, unnest(regexp_extract_all(md, {S.q(N.LINT_URL_RE)})) AS u FROM notes)),
dups AS (SELECT url, count(*) AS n_notes, list_sort(list(path))[1:5] AS paths FROM urls GROUP BY url HAVING count(*) > 1),
unsyn AS (SELECT path FROM notes r WHERE is_raw AND NOT EXISTS (SELECT 1 FROM notes s WHERE s.is_synthesis AND contains(s.md, r.name))),
missing AS (SELECT path, list_filter([{", ".join(f"CASE WHEN f_{f} = '' THEN '{f}' END" for f in N.REQUIRED_SOURCE_FIELDS)}],
                                     lambda x: x IS NOT NULL) AS missing
            FROM fields WHERE is_source),
promote AS (SELECT path FROM fields WHERE is_source AND
            ({" OR ".join(f"strpos(lower(f_title || ' ' || md), '{w}') > 0" for w in N.PROMOTE_KEYWORDS)}))"""


@register("note_frontmatter", oracle=f"""WITH {_NOTES_SQL}
SELECT regexp_replace(path, '^{VAULT}', '') AS path, name, f_title AS title, f_status AS status,
       len(list_distinct(list_transform(entries, lambda e: e.k))) AS n_fields, is_source, is_raw, is_synthesis
FROM fields""")
def note_frontmatter(spark: SparkSession, sf: str) -> DataFrame:
    """Notes with parsed front matter and folder layer."""
    n = vault_notes(spark, sf)
    return n.select(_rel(F.col("path")).alias("path"), "name",
                    F.coalesce(F.col("fm")["title"], F.lit("")).alias("title"),
                    F.coalesce(F.col("fm")["status"], F.lit("")).alias("status"),
                    F.size(F.map_keys("fm")).alias("n_fields"), "is_source", "is_raw", "is_synthesis")


@register("missing_fields", oracle=f"""WITH {_NOTES_SQL}
SELECT regexp_replace(path, '^{VAULT}', '') AS path, missing FROM missing WHERE len(missing) > 0""")
def missing_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Source notes with absent or empty required fields."""
    m = N.missing_fields(vault_notes(spark, sf))
    return m.select(_rel(F.col("path")).alias("path"), "missing")


@register("duplicate_urls", oracle=f"""WITH {_NOTES_SQL}
SELECT url, n_notes, list_transform(paths, lambda p: regexp_replace(p, '^{VAULT}', '')) AS paths FROM dups""")
def duplicate_urls(spark: SparkSession, sf: str) -> DataFrame:
    """A4: URLs found in more than one note (count and first 5 paths)."""
    d = N.duplicate_urls(vault_notes(spark, sf))
    return d.select("url", "n_notes", F.transform("paths", _rel).alias("paths"))


@register("unsynthesised", oracle=f"""WITH {_NOTES_SQL}
SELECT regexp_replace(path, '^{VAULT}', '') AS path FROM unsyn""")
def unsynthesised(spark: SparkSession, sf: str) -> DataFrame:
    """Raw notes whose file name no synthesis note contains."""
    return N.unsynthesised(vault_notes(spark, sf)).select(_rel(F.col("path")).alias("path"))


@register("lint_summary", oracle=f"""WITH {_NOTES_SQL}
SELECT (SELECT count(*) FROM notes) AS total_notes, (SELECT count(*) FILTER (WHERE is_source) FROM notes) AS source_notes,
       (SELECT count(*) FILTER (WHERE is_raw) FROM notes) AS raw_notes,
       (SELECT count(*) FROM missing WHERE len(missing) > 0) AS missing_frontmatter,
       (SELECT count(*) FROM dups) AS duplicate_urls,
       coalesce((SELECT list_sort(list(url)) FROM (SELECT url FROM dups ORDER BY url LIMIT 5)), []::VARCHAR[]) AS duplicate_sample,
       coalesce((SELECT list_sort(list(regexp_replace(path, '^{VAULT}', ''))) FROM (SELECT path FROM promote ORDER BY path LIMIT 20)), []::VARCHAR[]) AS promote,
       coalesce((SELECT list_sort(list(regexp_replace(path, '^{VAULT}', ''))) FROM (SELECT path FROM unsyn ORDER BY path LIMIT 20)), []::VARCHAR[]) AS unsynthesised,
       (SELECT count(*) FROM missing WHERE len(missing) > 0) = 0 AND (SELECT count(*) FROM dups) = 0 AS ok""")
def lint_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Corpus lint report as one row with bounded samples."""
    s = N.lint_summary(vault_notes(spark, sf))
    return s.select("total_notes", "source_notes", "raw_notes", "missing_frontmatter", "duplicate_urls",
                    "duplicate_sample", F.transform("promote", _rel).alias("promote"),
                    F.transform("unsynthesised", _rel).alias("unsynthesised"), "ok")
