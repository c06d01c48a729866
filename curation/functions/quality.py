"""Collected-record checks: quality gate, outline, need-materials, failure
reasons, probe verdicts, platform routing, topic and length routers."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from curation.functions.text import let, py_strip
from curation.functions.urls import netloc

# A fetched transcript is used above the one, a local one is
# rejected below the other.
API_MIN_CHARS, LOCAL_MIN_CHARS = 100, 50
# Separators of outline sentences.
OUTLINE_SPLIT = "[\n。!?！？]+"
# All Chinese hint words lie inside this block, so one class is exact.
CJK = "[一-鿿]"

# Platform tags of the outline, by host substring (in order).
PLATFORM_TAGS = [
    (["youtube", "youtu.be"], ["YouTube", "视频笔记"]),
    (["xiaohongshu", "xhslink"], ["小红书", "内容拆解"]),
    (["weixin", "wemp.app"], ["公众号", "长文提炼"]),
    (["twitter", "x.com"], ["X", "推文拆解"]),
]

# Missing-material texts of the collector.
MISSING_BODY = "正文内容"
PROVIDE_DEFAULT = "复制正文 OR 截图"
PROVIDE_YOUTUBE = "导出音频文件 OR 视频文件 OR 提供可访问字幕"


def platform(url: Column, vocab: str = "collector", match: str = "substring") -> Column:
    """E5: platform of a link by its lower-cased host (first rule wins).

    Vocabularies: ``collector`` youtube / x / web; ``inject`` (raw-text
    intake) adds xhs and wechat; ``workflow`` adds weixin and xiaohongshu.
    ``match='substring'`` keeps the loose host test (``netflix.com`` counts
    as x); ``match='domain'`` requires the host or one of its sub-domains.
    """
    h = F.lower(netloc(url))

    def has(*needles: str) -> Column:
        cond = F.lit(False)
        for s in needles:
            if match == "domain" and "." in s:
                cond = cond | (h == s) | h.endswith("." + s)
            else:
                cond = cond | (F.instr(h, s) > 0)
        return cond

    rules = {
        "collector": [(has("youtu"), "youtube"), (has("x.com", "twitter.com"), "x")],
        "inject": [(has("youtu"), "youtube"), (has("x.com", "twitter"), "x"),
                   (has("xiaohongshu", "xhslink"), "xhs"), (has("weixin", "wemp"), "wechat")],
        "workflow": [(has("youtu"), "youtube"), (has("x.com", "twitter.com"), "x"),
                     (has("weixin", "wemp.app", "mp.weixin"), "weixin"),
                     (has("xiaohongshu", "xhslink"), "xiaohongshu")],
    }[vocab]
    expr = None
    for cond, name in rules:
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise("web")


def rewrite_mirror(url: Column, host: str = "mp.weixin.qq.com", mirror: str = "wemp.app") -> Column:
    """Send a blocked host to its readable mirror before lookup."""
    return F.replace(url, F.lit(host), F.lit(mirror))


def quality_gate(title: Column, body: Column, min_chars: int = 300) -> Column:
    """struct(chars, title_ok, enough) of a collected record."""
    chars = F.length(py_strip(F.coalesce(body, F.lit(""))))
    return F.struct(chars.alias("chars"),
                    (py_strip(F.coalesce(title, F.lit(""))) != "").alias("title_ok"),
                    (chars >= min_chars).alias("enough"))


def transcript_gate(text: Column) -> Column:
    """E14 of transcripts: struct(chars, usable: over 100, too_short: under
    50)."""
    n = F.length(F.coalesce(text, F.lit("")))
    return F.struct(n.alias("chars"), (n > API_MIN_CHARS).alias("usable"), (n < LOCAL_MIN_CHARS).alias("too_short"))


def outline(url: Column, body: Column) -> Column:
    """struct(core_claim, support_points, quote_zh, quote_en, tags)."""
    host = F.lower(netloc(url))
    tags = None
    for needles, tg in PLATFORM_TAGS:
        cond = F.lit(False)
        for n in needles:
            cond = cond | (F.instr(host, n) > 0)
        arr = F.array(*[F.lit(t) for t in tg])
        tags = F.when(cond, arr) if tags is None else tags.when(cond, arr)
    tags = tags.otherwise(F.array().cast("array<string>"))
    empty_arr = F.array().cast("array<string>")

    def build(t: Column) -> Column:
        # ``t`` is the stripped text; ``lines`` is computed once below.
        def from_lines(lines: Column) -> Column:
            core = F.when(F.size(lines) > 0, F.try_element_at(lines, F.lit(1))).otherwise(F.substring(t, 1, 80))
            rest = F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1)))
            supports = F.transform(F.slice(F.filter(rest, lambda x: F.length(x) >= 12), 1, 3),
                                   lambda x: F.substring(x, 1, 140))
            en = F.try_element_at(F.filter(lines, lambda x: x.rlike("[A-Za-z]{3,}")), F.lit(1))
            zh = F.try_element_at(F.filter(lines, lambda x: x.rlike(CJK)), F.lit(1))
            return F.struct(F.substring(core, 1, 120).alias("core_claim"), supports.alias("support_points"),
                            F.coalesce(F.substring(zh, 1, 80), F.lit("")).alias("quote_zh"),
                            F.coalesce(F.substring(en, 1, 120), F.lit("")).alias("quote_en"),
                            F.slice(tags, 1, 3).alias("tags"))
        lines = F.filter(F.transform(F.split(t, OUTLINE_SPLIT), lambda x: py_strip(x)), lambda x: x != "")
        blank = F.struct(F.lit("").alias("core_claim"), empty_arr.alias("support_points"),
                         F.lit("").alias("quote_zh"), F.lit("").alias("quote_en"), empty_arr.alias("tags"))
        return F.when(t == "", blank).otherwise(let(lines, from_lines))

    return let(py_strip(F.coalesce(body, F.lit(""))), build)


def fail_reason(errors: Column) -> Column:
    """First matching rule over the error list (5 reasons)."""
    e = F.coalesce(errors, F.array().cast("array<string>"))
    return (F.when(F.exists(e, lambda x: (F.instr(x, "TranscriptsDisabled") > 0) | (F.instr(x, "Sign in") > 0)
                           | (F.instr(F.lower(x), "bot") > 0)), "youtube_blocked")
            .when(F.exists(e, lambda x: F.instr(x, "transcript_api_fail") > 0), "transcript_unavailable")
            .when(F.exists(e, lambda x: F.instr(x, "yt-dlp_fail") > 0), "download_failed")
            .when(F.size(e) > 0, "fetch_failed")
            .otherwise("content_empty"))


def fail_reason_of(error: Column) -> Column:
    """E17 as an aggregate over error rows: the first rule that any of a
    group's errors matches (a group without rows is ``content_empty``)."""
    blocked = (F.instr(error, "TranscriptsDisabled") > 0) | (F.instr(error, "Sign in") > 0) \
        | (F.instr(F.lower(error), "bot") > 0)
    return (F.when(F.bool_or(blocked), "youtube_blocked")
            .when(F.bool_or(F.instr(error, "transcript_api_fail") > 0), "transcript_unavailable")
            .when(F.bool_or(F.instr(error, "yt-dlp_fail") > 0), "download_failed")
            .otherwise("fetch_failed"))


def need_material(url: Column, platform_col: Column, title: Column, body: Column, errors: Column,
                  min_chars: int = 300) -> Column:
    """struct(source, got, missing, provide, fail_reason, errors<=3)."""
    chars = F.length(py_strip(F.coalesce(body, F.lit(""))))
    missing = (F.when(chars == 0, F.lit(MISSING_BODY))
               .when(chars < min_chars, F.format_string(f"正文不足{min_chars}字（当前%d）", chars))
               .otherwise(F.lit(MISSING_BODY)))
    provide = F.when(platform_col == "youtube", F.lit(PROVIDE_YOUTUBE)).otherwise(F.lit(PROVIDE_DEFAULT))
    got = F.concat(F.lit("标题「"), F.coalesce(title, F.lit("(无)")), F.lit("」"))
    return F.struct(url.alias("source"), got.alias("got"), missing.alias("missing"), provide.alias("provide"),
                    fail_reason(errors).alias("fail_reason"),
                    F.slice(F.coalesce(errors, F.array().cast("array<string>")), 1, 3).alias("errors"))


def transcript_verdict(error: Column) -> Column:
    """E18 transcript probe: error text -> PASS/BLOCKED/NO_CAPTIONS/AUTH_FAIL/ERROR."""
    e = F.lower(error)
    return (F.when(error.isNull() | (error == ""), "PASS")
            .when((F.instr(e, "sign in") > 0) | (F.instr(e, "confirm") > 0) | (F.instr(e, "bot") > 0), "BLOCKED")
            .when((F.instr(e, "transcriptsdisabled") > 0) | (F.instr(e, "notranscript") > 0), "NO_CAPTIONS")
            .when((F.instr(error, "403") > 0) | (F.instr(error, "401") > 0) | (F.instr(e, "auth") > 0), "AUTH_FAIL")
            .otherwise("ERROR"))


def metadata_verdict(ok: Column, output: Column) -> Column:
    """E18 metadata probe: success with output, else text rules."""
    e = F.lower(F.coalesce(output, F.lit("")))
    return (F.when(ok & (F.instr(e, "|||") > 0), "PASS")
            .when((F.instr(e, "sign in") > 0) | (F.instr(e, "confirm") > 0) | (F.instr(e, "bot") > 0), "BLOCKED")
            .when((F.instr(e, "403") > 0) | (F.instr(e, "401") > 0), "AUTH_FAIL")
            .otherwise("ERROR"))


# Documented topic classes (A technical, B product, C opinion,
# D tools) with Chinese and English keywords; priority A > B > C > D, default C.
TOPIC_CLASSES = [
    ("A", ["架构", "实验", "评测", "论文", "模型", "部署", "工程", "方法", "框架",
           "architecture", "benchmark", "paper", "experiment", "model", "deploy", "method"]),
    ("B", ["发布", "上线", "融资", "收购", "宣布", "推出", "合作",
           "launch", "raises", "funding", "acquisition", "announces", "releases"]),
    ("C", ["我认为", "我觉得", "未来", "反思", "复盘", "洞察", "判断", "预测",
           "i think", "in my view", "future of", "prediction", "reflection", "lessons"]),
    ("D", ["工具", "教程", "开源", "模板", "资源", "怎么用", "手把手",
           "tool", "tutorial", "open source", "how to", "template", "resource"]),
]


def topic_class(title: Column, body: Column, head_chars: int = 200) -> Column:
    """Topic class of title + first 200 body chars (case-insensitive)."""
    probe = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")),
                                F.substring(F.coalesce(body, F.lit("")), 1, head_chars)))
    expr = None
    for cls, words in TOPIC_CLASSES:
        cond = F.lit(False)
        for w in words:
            cond = cond | (F.instr(probe, w) > 0)
        expr = F.when(cond, cls) if expr is None else expr.when(cond, cls)
    return expr.otherwise("C")


def length_route(n_chars: Column, full_below: int = 3000, light_above: int = 10000,
                 segment: int = 3000) -> Column:
    """struct(route, segments): full / segmented (<= 3000 each) / light."""
    route = (F.when(n_chars < full_below, "full").when(n_chars <= light_above, "segmented").otherwise("light"))
    segs = F.when(route == "segmented", F.ceil(n_chars / F.lit(segment)).cast("int")).otherwise(F.lit(1))
    return F.struct(route.alias("route"), segs.alias("segments"))


def keyword_any(text: Column, words: Sequence[str]) -> Column:
    """True when the lower-cased text contains any of the words."""
    from curation.functions.scoring import any_keyword
    return any_keyword(text, words)
