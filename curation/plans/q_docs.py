"""Registered queries over ``documents`` (and ``labels``): excerpts, outline,
quality gate, need-materials, keyword flags, top digest, routers, chunks and
per-source budgets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curation.functions import quality as Q
from curation.functions.scoring import score_sources
from curation.functions.text import approx_tokens, excerpt, py_strip
from curation.operators.budget import select_for_budget
from curation.operators.chunk import chunk_documents
from curation.operators.topk import DEEP_DIVE_KEYWORDS, top_digest
from curation.plans import sqlgen as S
from curation.plans.registry import register
from curation.session import materialize, read_table
from curation.sources.pages import empty_errors, empty_meta

# Keywords that make a note a promote candidate.
PROMOTE_KEYWORDS = ["obsidian", "wiki", "agent", "context", "codex", "claude", "eval", "pipeline"]
# Planned RSS filter (documented): keyword list and minimum length.
FEED_KEYWORDS = ["ai", "llm", "agent"]
FEED_MIN_LENGTH = 500
# Stand-in hosts per language so that the platform rules see every platform.
LANG_HOSTS = {"en": "www.youtube.com", "fr": "x.com", "de": "www.xiaohongshu.com", "es": "mp.weixin.qq.com"}


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "documents")


def _host_expr(lang: F.Column) -> F.Column:
    expr = None
    for k, v in LANG_HOSTS.items():
        expr = F.when(lang == k, v) if expr is None else expr.when(lang == k, v)
    return expr.otherwise("blog.example.com")


def doc_records(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as collected records: url, title (first line), body."""
    d = _docs(spark, sf)
    return d.select("doc_id", "source", "lang", "n_chars",
                    F.concat(F.lit("https://"), _host_expr(F.col("lang")), F.lit("/doc/"), F.col("doc_id"))
                    .alias("url"),
                    py_strip(F.substring_index(F.col("text"), "\n", 1)).alias("title"),
                    F.col("text").alias("body"))


def _host_sql(lang: str) -> str:
    whens = " ".join(f"WHEN {lang} = {S.q(k)} THEN {S.q(v)}" for k, v in LANG_HOSTS.items())
    return f"(CASE {whens} ELSE 'blog.example.com' END)"


_REC_SQL = f"""rec AS (
  SELECT doc_id, source, lang, n_chars, 'https://' || {_host_sql('lang')} || '/doc/' || doc_id AS url,
         {S.strip("split_part(text, chr(10), 1)")} AS title, text AS body
  FROM documents)"""


def _excerpt_sql(text: str, tok: str) -> str:
    clean = f"regexp_replace({S.strip(text)}, '\\n{{3,}}', chr(10) || chr(10), 'g')".replace("\\n", "\n")
    lim = f"greatest(120, {tok} * 4)"
    head = f"substr({clean}, 1, {lim})"
    before = f"(CASE WHEN strpos({head}, ' ') > 0 THEN regexp_extract({head}, '(?s)^(.*) ', 1) ELSE {head} END)"
    cut = f"regexp_replace({before}, {S.q(S.SPACE + '+$')}, '')"
    return f"(CASE WHEN length({clean}) <= {lim} THEN {clean} ELSE {cut} || '...' END)"


@register("excerpts", oracle=f"""SELECT doc_id, least({S.tokens("''", 'text')}, 900) AS token_limit,
  {_excerpt_sql('text', f"least({S.tokens(chr(39) * 2, 'text')}, 900)")} AS excerpt FROM documents""")
def excerpts(spark: SparkSession, sf: str) -> DataFrame:
    """Excerpt of every document at min(tokens, 900)."""
    d = _docs(spark, sf)
    tok = F.least(approx_tokens(F.lit(""), F.col("text")), F.lit(900))
    return d.select("doc_id", tok.alias("token_limit"), excerpt(F.col("text"), tok).alias("excerpt"))


def _outline_sql() -> str:
    lines = (f"list_filter(list_transform(regexp_split_to_array({S.strip('body')}, {S.q(Q.OUTLINE_SPLIT)}), "
             f"lambda x: {S.strip('x')}), lambda x: x <> '')")
    return f"""WITH {_REC_SQL},
o AS (SELECT doc_id, url, {S.strip('body')} AS t, {lines} AS lines FROM rec)
SELECT doc_id,
  CASE WHEN t = '' THEN '' ELSE substr(CASE WHEN len(lines) > 0 THEN lines[1] ELSE substr(t, 1, 80) END, 1, 120) END AS core_claim,
  CASE WHEN t = '' THEN []::VARCHAR[] ELSE list_transform(list_slice(list_filter(list_slice(lines, 2, len(lines)), lambda x: length(x) >= 12), 1, 3), lambda x: substr(x, 1, 140)) END AS support_points,
  CASE WHEN t = '' THEN '' ELSE coalesce(substr(list_filter(lines, lambda x: regexp_matches(x, '{Q.CJK}'))[1], 1, 80), '') END AS quote_zh,
  CASE WHEN t = '' THEN '' ELSE coalesce(substr(list_filter(lines, lambda x: regexp_matches(x, '[A-Za-z]{{3,}}'))[1], 1, 120), '') END AS quote_en,
  CASE WHEN t = '' THEN []::VARCHAR[]
       WHEN strpos(lower({S.netloc('url')}), 'youtube') > 0 OR strpos(lower({S.netloc('url')}), 'youtu.be') > 0 THEN ['YouTube', '视频笔记']
       WHEN strpos(lower({S.netloc('url')}), 'xiaohongshu') > 0 OR strpos(lower({S.netloc('url')}), 'xhslink') > 0 THEN ['小红书', '内容拆解']
       WHEN strpos(lower({S.netloc('url')}), 'weixin') > 0 OR strpos(lower({S.netloc('url')}), 'wemp.app') > 0 THEN ['公众号', '长文提炼']
       WHEN strpos(lower({S.netloc('url')}), 'twitter') > 0 OR strpos(lower({S.netloc('url')}), 'x.com') > 0 THEN ['X', '推文拆解']
       ELSE []::VARCHAR[] END AS tags
FROM o"""


@register("outline", oracle=_outline_sql())
def outline(spark: SparkSession, sf: str) -> DataFrame:
    """Structured outline of every collected record."""
    r = doc_records(spark, sf).select("doc_id", Q.outline(F.col("url"), F.col("body")).alias("o"))
    return r.select("doc_id", "o.core_claim", "o.support_points", "o.quote_zh", "o.quote_en", "o.tags")


@register("quality_gate", oracle=f"""WITH {_REC_SQL}
SELECT doc_id, length({S.strip('body')}) AS chars, {S.strip('title')} <> '' AS title_ok,
       length({S.strip('body')}) >= 300 AS enough FROM rec""")
def quality_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Chars / title_ok / enough (min 300 chars)."""
    r = doc_records(spark, sf).select("doc_id", Q.quality_gate(F.col("title"), F.col("body")).alias("g"))
    return r.select("doc_id", "g.chars", "g.title_ok", "g.enough")


@register("need_materials", oracle=f"""WITH {_REC_SQL}
SELECT doc_id, url AS source, '标题「' || title || '」' AS got,
  CASE WHEN length({S.strip('body')}) = 0 THEN '正文内容' ELSE '正文不足300字（当前' || length({S.strip('body')}) || '）' END AS missing,
  CASE WHEN {_host_sql('lang')} LIKE '%youtu%' THEN '导出音频文件 OR 视频文件 OR 提供可访问字幕' ELSE '复制正文 OR 截图' END AS provide,
  'content_empty' AS fail_reason, []::VARCHAR[] AS errors
FROM rec WHERE length({S.strip('body')}) < 300""")
def need_materials(spark: SparkSession, sf: str) -> DataFrame:
    """What to provide for every record that fails the gate."""
    r = doc_records(spark, sf)
    r = r.withColumn("platform", Q.platform(F.col("url"))).withColumn("errors", empty_errors())
    gate = Q.quality_gate(F.col("title"), F.col("body"))
    nm = Q.need_material(F.col("url"), F.col("platform"), F.col("title"), F.col("body"), F.col("errors"))
    r = r.filter(~gate["enough"]).select("doc_id", nm.alias("m"))
    return r.select("doc_id", "m.source", "m.got", "m.missing", "m.provide", "m.fail_reason", "m.errors")


def _kw_sql(x: str, words) -> str:
    return "(" + " OR ".join(f"strpos(lower({x}), {S.q(w)}) > 0" for w in words) + ")"


@register("keyword_flags", oracle=f"""WITH {_REC_SQL}
SELECT doc_id, {_kw_sql("title || ' ' || body", PROMOTE_KEYWORDS)} AS promote,
       {_kw_sql('title || body', DEEP_DIVE_KEYWORDS)} AS deep_dive FROM rec""")
def keyword_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Promote-candidate (8 words) and deep-dive (6 words) flags."""
    r = doc_records(spark, sf)
    return r.select("doc_id",
                    Q.keyword_any(F.concat_ws(" ", "title", "body"), PROMOTE_KEYWORDS).alias("promote"),
                    Q.keyword_any(F.concat("title", "body"), DEEP_DIVE_KEYWORDS).alias("deep_dive"))


def digest_items(spark: SparkSession, sf: str) -> DataFrame:
    """Documents + labels as digest items (title, url, type, score, body)."""
    r = doc_records(spark, sf)
    lab = read_table(spark, sf, "labels")
    r = r.join(lab, "doc_id", "left")
    score = (F.least(F.lit(40), F.floor(F.col("n_chars") / 80)) + 10 * F.coalesce("quality", F.lit(0))
             - 20 * F.coalesce("toxic", F.lit(0))).cast("int")
    return r.select("doc_id", "title", F.concat(F.lit("doc:"), F.col("doc_id")).alias("url"),
                    F.col("source").alias("type"), score.alias("score"),
                    F.substring("body", 1, 240).alias("body"))


@register("top_digest", oracle=f"""WITH {_REC_SQL},
items AS (
  SELECT r.doc_id, r.title, CAST(least(40, r.n_chars // 80) + 10 * coalesce(l.quality, 0) - 20 * coalesce(l.toxic, 0) AS INTEGER) AS score,
         substr(r.body, 1, 240) AS body
  FROM rec r LEFT JOIN labels l ON r.doc_id = l.doc_id),
top AS (SELECT *, row_number() OVER (ORDER BY score DESC, title, doc_id) AS rank FROM items ORDER BY score DESC, title, doc_id LIMIT 5),
flag AS (SELECT *, {_kw_sql('title || body', DEEP_DIVE_KEYWORDS)} AS hit FROM top)
SELECT rank, doc_id, title, score, hit AND row_number() OVER (PARTITION BY hit ORDER BY rank) <= 3 AS deep,
       substr({S.strip("replace(body, chr(10), ' ')")}, 1, 160) AS summary
FROM flag""")
def top_digest_q(spark: SparkSession, sf: str) -> DataFrame:
    """Top 5 items by (score desc, title), deep-dive subset of 3."""
    t = top_digest(digest_items(spark, sf), 5, 3, order_extra=["doc_id"])
    return t.select("rank", "doc_id", "title", "score", "deep", "summary")


def _topic_sql(title: str, body: str) -> str:
    probe = f"lower({title} || ' ' || substr({body}, 1, 200))"
    whens = " ".join(f"WHEN {_kw_sql(probe, words)} THEN '{cls}'" for cls, words in Q.TOPIC_CLASSES)
    return f"(CASE {whens} ELSE 'C' END)"


@register("topic_router", oracle=f"""WITH {_REC_SQL}
SELECT doc_id, {_topic_sql('title', 'body')} AS topic FROM rec""")
def topic_router(spark: SparkSession, sf: str) -> DataFrame:
    """Topic class A/B/C/D from title + first 200 chars."""
    r = doc_records(spark, sf)
    return r.select("doc_id", Q.topic_class(F.col("title"), F.col("body")).alias("topic"))


@register("length_router", oracle="""SELECT doc_id, n_chars,
  CASE WHEN n_chars < 3000 THEN 'full' WHEN n_chars <= 10000 THEN 'segmented' ELSE 'light' END AS route,
  CASE WHEN n_chars >= 3000 AND n_chars <= 10000 THEN CAST(ceil(n_chars / 3000) AS INTEGER) ELSE 1 END AS segments
FROM documents""")
def length_router(spark: SparkSession, sf: str) -> DataFrame:
    """Full / segmented / light by length."""
    d = _docs(spark, sf)
    r = Q.length_route(F.col("n_chars"))
    return d.select("doc_id", "n_chars", r["route"].alias("route"), r["segments"].alias("segments"))


@register("feed_filters", oracle=f"""SELECT doc_id, length(text) AS n_chars FROM documents
WHERE length(text) >= {FEED_MIN_LENGTH} AND {_kw_sql('text', FEED_KEYWORDS)}""")
def feed_filters(spark: SparkSession, sf: str) -> DataFrame:
    """keep feed texts of at least 500 chars that hit a keyword."""
    d = _docs(spark, sf)
    return (d.filter((F.length("text") >= FEED_MIN_LENGTH) & Q.keyword_any(F.col("text"), FEED_KEYWORDS))
            .select("doc_id", F.length("text").alias("n_chars")))


def _chunks_sql(size: int = 1800, sep_min: int = 400) -> str:
    win = f"substr(rest, 1, {size})"
    idx = (f"(CASE WHEN strpos({win}, chr(10) || chr(10)) > 0 "
           f"THEN length(regexp_extract({win}, '(?s)^(.*)\n\n', 1)) ELSE -1 END)")
    return f"""WITH RECURSIVE d AS (SELECT doc_id, {S.strip('text')} AS rest FROM documents),
c(doc_id, part_no, part, rest) AS (
  SELECT doc_id, -1, CAST(NULL AS VARCHAR), rest FROM d WHERE rest <> ''
  UNION ALL
  SELECT doc_id, part_no + 1,
         CASE WHEN length(rest) <= {size} THEN rest ELSE {S.strip('substr(rest, 1, cut)')} END,
         CASE WHEN length(rest) <= {size} THEN '' ELSE {S.strip('substr(rest, cut + 1)')} END
  FROM (SELECT *, CASE WHEN {idx} < {sep_min} THEN {size} ELSE {idx} END AS cut FROM c WHERE rest <> ''))
SELECT doc_id, part_no, part, length(part) AS part_chars FROM c WHERE part_no >= 0
UNION ALL SELECT doc_id, 0, '', 0 FROM d WHERE rest = ''"""


@register("chunks", oracle=_chunks_sql())
def chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Every document split into <= 1800-char parts."""
    return chunk_documents(_docs(spark, sf), "text", ["doc_id"], profile="page")


def doc_sources(spark: SparkSession, sf: str) -> DataFrame:
    r = doc_records(spark, sf)
    return r.select(F.col("doc_id").alias("ordinal"), "source",
                    F.concat(F.lit("doc:"), F.col("doc_id")).alias("canonical_url"), "title", "body",
                    F.lit("web").alias("source_type"), F.lit("fetch").alias("method"),
                    empty_errors().alias("errors"), empty_meta().alias("metadata"))


@register("budget_by_source", oracle=f"""WITH RECURSIVE {_REC_SQL},
src AS (SELECT doc_id, source, 'doc:' || doc_id AS canonical_url, title, body, 0 AS priority FROM rec),
sc AS (SELECT *, {S.tokens('title', 'body')} AS approx_tokens,
              {S.quality('priority', 'title', 'body', "'fetch'", '0')} AS quality_score FROM src),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY quality_score DESC, priority DESC, canonical_url) AS rn FROM sc),
{S.budget_walk('ranked', 4000, 900, ['source'])}
SELECT r.source, r.canonical_url, r.quality_score, r.approx_tokens,
       CASE WHEN w.take THEN w.needed ELSE 0 END AS selected_tokens, w.take AS selected
FROM ranked r JOIN walk w ON r.source = w.source AND r.rn = w.rn""")
def budget_by_source(spark: SparkSession, sf: str) -> DataFrame:
    """W1 per key: one 4000-token budget per document source."""
    s = score_sources(doc_sources(spark, sf), [])
    s = materialize(s.select("source", "canonical_url", "quality_score", "priority", "approx_tokens"))
    sel = select_for_budget(s, 4000, 900, keys=["source"])
    return sel.select("source", "canonical_url", "quality_score", "approx_tokens", "selected_tokens", "selected")


@register("handoff_need_materials", oracle=f"""WITH {_REC_SQL}
SELECT doc_id, url AS source_url, '标题「' || title || '」' AS got,
  CASE WHEN length({S.strip('body')}) = 0 THEN '正文内容' ELSE '正文不足300字（当前' || length({S.strip('body')}) || '）' END AS missing,
  CASE WHEN {_host_sql('lang')} LIKE '%youtu%' THEN '导出音频文件 OR 视频文件 OR 提供可访问字幕' ELSE '复制正文 OR 截图' END AS provide,
  'content_empty' AS fail_reason, []::VARCHAR[] AS errors
FROM rec WHERE length({S.strip('body')}) < 300""")
def handoff_need_materials(spark: SparkSession, sf: str) -> DataFrame:
    """K4: need-material rows mapped to the hand-off schema with defaults."""
    from curation.operators.records import handoff_need_materials as op
    nm = need_materials(spark, sf)
    return op(nm).join(nm.select("doc_id", "source"), F.col("source_url") == F.col("source")) \
        .select("doc_id", "source_url", "got", "missing", "provide", "fail_reason", "errors")
