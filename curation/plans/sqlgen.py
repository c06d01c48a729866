"""DuckDB SQL fragments for the oracle queries (independent re-statement of
the same rules in another engine's dialect; used only for checking)."""

from __future__ import annotations

from typing import Sequence

from curation.functions.text import INLINE_SPACE, LINE_BREAK, SPACE
from curation.functions.urls import PARAM_SCHEMES, TRACKING_PARAMS, URL_PARTS_RE

NL = "chr(10)"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + SPACE + '+|' + SPACE + '+$')}, '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, {q(SPACE + '+')}, ' ', 'g'))"


# Entities present in the test pages; "&amp;" last so nothing decodes twice.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"),
            ("&middot;", "·"), ("&nbsp;", " "), ("&amp;", "&")]


def unescape(x: str) -> str:
    for a, b in ENTITIES:
        x = f"replace({x}, {q(a)}, {q(b)})"
    return x


def clean_lines(x: str) -> str:
    t = f"regexp_replace({x}, {q(chr(13) + chr(10) + '|' + LINE_BREAK)}, {NL}, 'g')"
    t = f"regexp_replace({t}, {q(INLINE_SPACE + '+')}, ' ', 'g')"
    t = f"regexp_replace({t}, {q(' *' + chr(10) + '[ ' + chr(10) + ']*')}, {NL}, 'g')"
    return f"regexp_replace({t}, {q('^[ ' + chr(10) + ']+|[ ' + chr(10) + ']+$')}, '', 'g')"


def strip_tags(x: str) -> str:
    t = f"regexp_replace({x}, '(?is)<script.*?>.*?</script>', ' ', 'g')"
    t = f"regexp_replace({t}, '(?is)<style.*?>.*?</style>', ' ', 'g')"
    t = f"regexp_replace({t}, {q('(?is)<br' + SPACE + '*/?>')}, {NL}, 'g')"
    t = f"regexp_replace({t}, {q('(?is)</p' + SPACE + '*>')}, {NL}, 'g')"
    return f"regexp_replace({t}, '(?is)<[^>]+>', ' ', 'g')"


def html_to_text(x: str) -> str:
    return clean_lines(unescape(strip_tags(x)))


def _meta_pats(name: str) -> list[str]:
    n = name.replace(".", "\\.")
    return [
        f"""(?is)<meta[^>]+name=["']{n}["'][^>]+content=["'](.*?)["']""",
        f"""(?is)<meta[^>]+property=["']{n}["'][^>]+content=["'](.*?)["']""",
        f"""(?is)<meta[^>]+content=["'](.*?)["'][^>]+(?:name|property)=["']{n}["']""",
    ]


def meta_content(x: str, names: Sequence[str]) -> str:
    whens = []
    for n in names:
        for p in _meta_pats(n):
            whens.append(f"WHEN regexp_matches({x}, {q(p)}) THEN {unescape(collapse(f'regexp_extract({x}, {q(p)}, 1)'))}")
    return "(CASE " + " ".join(whens) + " ELSE '' END)"


def title_tag(x: str) -> str:
    p = "(?is)<title[^>]*>(.*?)</title>"
    return (f"(CASE WHEN regexp_matches({x}, {q(p)}) THEN "
            f"{unescape(collapse(f'regexp_extract({x}, {q(p)}, 1)'))} ELSE '' END)")


def page_title(x: str) -> str:
    og = meta_content(x, ["og:title", "twitter:title"])
    return f"(CASE WHEN {og} <> '' THEN {og} ELSE {title_tag(x)} END)"


def looks_like_html(x: str) -> str:
    return (f"(strpos(lower(substr({x}, 1, 500)), '<html') > 0 OR "
            f"strpos(lower(substr({x}, 1, 2000)), '<title') > 0)")


def page_body(x: str) -> str:
    text = html_to_text(x)
    desc = meta_content(x, ["description", "og:description", "twitter:description"])
    html_body = (f"(CASE WHEN {desc} <> '' AND strpos(substr({text}, 1, 500), {desc}) = 0 "
                 f"THEN {desc} || {NL} || {NL} || {text} ELSE {text} END)")
    return f"(CASE WHEN {looks_like_html(x)} THEN {html_body} ELSE {strip(x)} END)"


def page_title_or_empty(x: str) -> str:
    return f"(CASE WHEN {looks_like_html(x)} THEN {page_title(x)} ELSE '' END)"


def _dec(x: str) -> str:
    return f"url_decode(replace({x}, '+', ' '))"


def _enc(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def canonical_url(x: str) -> str:
    """Canonical URL as one DuckDB expression."""
    u = f"regexp_replace(regexp_replace({strip(x)}, {q('^[' + chr(0) + '-' + chr(32) + ']+')}, '', 'g'), {q('[' + chr(9) + chr(13) + chr(10) + ']')}, '', 'g')"
    P = q(URL_PARTS_RE)
    scheme = f"lower(regexp_extract({u}, {P}, 1))"
    netloc = f"regexp_extract({u}, {P}, 2)"
    path = f"regexp_extract({u}, {P}, 3)"
    query = f"regexp_extract({u}, {P}, 4)"
    h = f"lower({netloc})"
    host = (f"(CASE WHEN {scheme} = 'http' AND suffix({h}, ':80') THEN left({h}, length({h}) - 3) "
            f"WHEN {scheme} = 'https' AND suffix({h}, ':443') THEN left({h}, length({h}) - 4) ELSE {h} END)")
    schemes = ", ".join(q(s) for s in PARAM_SCHEMES)
    p1 = f"(CASE WHEN {scheme} IN ({schemes}) THEN regexp_replace({path}, ';[^/]*$', '') ELSE {path} END)"
    p2 = f"(CASE WHEN {p1} = '' THEN '/' ELSE regexp_replace({p1}, '(?s)(.)/$', '\\1') END)"
    tracking = ", ".join(q(t) for t in TRACKING_PARAMS)
    pairs = f"list_filter(string_split({query}, '&'), lambda x: x <> '')"
    kv = (f"list_transform({pairs}, lambda x: struct_pack(k := {_dec('split_part(x, ' + q('=') + ', 1)')}, "
          f"v := {_dec('(CASE WHEN strpos(x, ' + q('=') + ') > 0 THEN substr(x, strpos(x, ' + q('=') + ') + 1) ELSE ' + q('') + ' END)')}))")
    kept = f"list_filter({kv}, lambda p: NOT (lower(p.k) IN ({tracking}) OR starts_with(lower(p.k), 'utm_')))"
    qs = f"array_to_string(list_transform({kept}, lambda p: {_enc('p.k')} || '=' || {_enc('p.v')}), '&')"
    built = f"{scheme} || '://' || {host} || {p2} || (CASE WHEN {qs} <> '' THEN '?' || {qs} ELSE '' END)"
    return f"(CASE WHEN {scheme} <> '' AND {netloc} <> '' THEN {built} ELSE {strip(x)} END)"


def netloc(x: str) -> str:
    return f"regexp_extract({x}, {q('^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)')}, 1)"


def domain(x: str) -> str:
    return f"regexp_replace(lower({netloc(x)}), '^www\\.', '')"


def domain_priority(x: str, domains: Sequence[str]) -> str:
    h = domain(x)
    n = len(domains)
    whens = []
    for i, d in enumerate(domains):
        d = d.lower()
        d = d[4:] if d.startswith("www.") else d
        whens.append(f"WHEN {h} = {q(d)} OR suffix({h}, {q('.' + d)}) THEN {max(1, n - i)}")
    return "(CASE " + " ".join(whens) + " ELSE 0 END)" if whens else "0"


def tokens(title: str, body: str) -> str:
    return f"greatest(1, (length({title}) + 1 + length({body}) + 3) // 4)"


def quality(priority: str, title: str, body: str, method: str, nerrors: str) -> str:
    return (f"greatest(0, {priority} * 10 + least(40, length({body}) // 80) + "
            f"(CASE WHEN {title} <> '' THEN 8 ELSE 0 END) + "
            f"(CASE WHEN {method} IN ('fetch','cache','github_starred','feed_fetch','feed_cache') THEN 12 ELSE 2 END)"
            f" - (CASE WHEN {nerrors} > 0 THEN 20 ELSE 0 END))")


def budget_walk(ranked: str, budget: int, per_source: int, keys: Sequence[str] = (), name: str = "walk") -> str:
    """Recursive CTE body: walk ``ranked`` (needs ``rn`` from 1 and
    ``approx_tokens``) and return ``(keys..., rn, take, needed)``."""
    k = list(keys)
    kj = "".join(f" AND r.{c} = w.{c}" for c in k)
    ksel_r = "".join(f"r.{c}, " for c in k)
    kseed = "".join(f"{c}, " for c in k)
    return f"""{name} AS (
  SELECT {kseed}rn, least(approx_tokens, {per_source}) AS needed,
         least(approx_tokens, {per_source}) <= {budget} AS take,
         CASE WHEN least(approx_tokens, {per_source}) <= {budget} THEN {budget} - least(approx_tokens, {per_source}) ELSE {budget} END AS remaining
  FROM {ranked} WHERE rn = 1
  UNION ALL
  SELECT {ksel_r}r.rn, least(r.approx_tokens, {per_source}),
         least(r.approx_tokens, {per_source}) <= w.remaining,
         CASE WHEN least(r.approx_tokens, {per_source}) <= w.remaining THEN w.remaining - least(r.approx_tokens, {per_source}) ELSE w.remaining END
  FROM {name} w JOIN {ranked} r ON r.rn = w.rn + 1{kj}
)"""
