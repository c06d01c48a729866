"""URL column expressions: canonical form, host, ids, platform routing.

Everything is a JVM-side Column expression (regex groups, higher-order array
functions, ``url_decode``/``url_encode``); no Python UDF is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curation.functions.text import py_strip

# Query keys dropped from canonical URLs, plus any key that
# starts with one of the prefixes (compared lower-cased).
TRACKING_PARAMS = ["fbclid", "gclid", "igshid", "mc_cid", "mc_eid", "ref", "spm"]
TRACKING_PREFIXES = ["utm_"]

# Schemes whose last path segment may carry ";params"
# (Python urllib.parse.uses_params).
PARAM_SCHEMES = ["", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp",
                 "rtsp", "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel"]

# Hosts of short social posts (strict test).
X_HOSTS = ["x.com", "twitter.com", "mobile.twitter.com"]

SCHEME_RE = r"[A-Za-z][A-Za-z0-9+.\-]*"
# scheme :// netloc path ?query  (fragment ignored)
URL_PARTS_RE = rf"^({SCHEME_RE})://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
NETLOC_RE = rf"^(?:{SCHEME_RE}:)?//([^/?#]*)"


def _prepared(url: Column) -> Column:
    """``url.strip()`` then urlsplit's own clean-up (C0 prefix, tab/CR/LF)."""
    s = py_strip(url)
    s = F.regexp_replace(s, r"^[\x00-\x20]+", "")
    return F.regexp_replace(s, r"[\t\r\n]", "")


def _qs_decode(c: Column) -> Column:
    # urllib unquote keeps a malformed "%" escape literally; Java throws on it.
    return F.url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"))


def _qs_encode(c: Column) -> Column:
    # quote_plus keeps "~" and escapes "*"; Java's encoder does the opposite.
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")),
                     F.lit("%7E"), F.lit("~"))


def canonical_url(url: Column) -> Column:
    """Canonical URL (lower scheme/host, default port, no params/fragment,
    tracking keys dropped, query re-encoded in order, one trailing "/" cut).

    Inputs without a scheme or a host come back stripped and unchanged.
    """
    s = py_strip(url)
    u = _prepared(url)
    scheme = F.lower(F.regexp_extract(u, URL_PARTS_RE, 1))
    netloc = F.regexp_extract(u, URL_PARTS_RE, 2)
    path = F.regexp_extract(u, URL_PARTS_RE, 3)
    query = F.regexp_extract(u, URL_PARTS_RE, 4)

    host = F.lower(netloc)
    host = F.when((scheme == "http") & host.endswith(":80"),
                  F.regexp_replace(host, ":80$", "")) \
        .when((scheme == "https") & host.endswith(":443"),
              F.regexp_replace(host, ":443$", "")) \
        .otherwise(host)

    path = F.when(scheme.isin(PARAM_SCHEMES), F.regexp_replace(path, ";[^/]*$", "")).otherwise(path)
    path = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, "(?s)(.)/$", "$1"))

    pairs = F.filter(F.split(query, "&"), lambda x: x != "")
    kept = F.filter(
        F.transform(pairs, lambda x: F.struct(
            _qs_decode(F.substring_index(x, "=", 1)).alias("k"),
            _qs_decode(F.when(F.instr(x, "=") > 0,
                              F.substring(x, F.instr(x, "=") + 1, F.lit(1 << 30)))
                       .otherwise(F.lit(""))).alias("v"))),
        lambda p: ~(F.lower(p["k"]).isin(TRACKING_PARAMS)
                    | F.lower(p["k"]).startswith(TRACKING_PREFIXES[0])),
    )
    q = F.array_join(F.transform(kept, lambda p: F.concat(_qs_encode(p["k"]), F.lit("="),
                                                          _qs_encode(p["v"]))), "&")
    built = F.concat(scheme, F.lit("://"), host, path,
                     F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))
    ok = (scheme != "") & (netloc != "")
    return F.when(url.isNull(), F.lit(None)).when(ok, built).otherwise(s)


def netloc(url: Column) -> Column:
    """``urlparse(url).netloc`` (userinfo and port included)."""
    return F.regexp_extract(F.regexp_replace(url, r"[\t\r\n]", ""), NETLOC_RE, 1)


def domain(url: Column) -> Column:
    """Lower-cased netloc without one leading ``www.``."""
    return F.regexp_replace(F.lower(netloc(url)), r"^www\.", "")


def is_x_url(url: Column) -> Column:
    h = domain(url)
    return h.isin(X_HOSTS) | h.endswith(".twitter.com")


def post_id(url: Column) -> Column:
    """Numeric id of a status link (``/status/123`` or ``/statuses/123``)."""
    path = F.regexp_extract(url, URL_PARTS_RE, 3)
    return F.regexp_extract(path, r"/status(?:es)?/(\d+)", 1)


def video_id(url: Column) -> Column:
    """Video id: ``youtu.be/`` tail, else ``v=`` query value, else ``/shorts/``.

    ``url.split('youtu.be/')[-1].split('?')[0]``; ``parse_qs(query)['v'][0]``
    (first non-blank ``v`` value, "+" and escapes decoded); shorts path id.
    """
    tail = F.substring_index(F.element_at(F.split(url, "youtu\\.be/"), -1), "?", 1)
    query = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?[^?#]*\?([^#]*)", 1)
    vals = F.filter(F.transform(F.filter(F.split(query, "&"), lambda x: F.instr(x, "=") > 0),
                                lambda x: F.struct(_qs_decode(F.substring_index(x, "=", 1)).alias("k"),
                                                   _qs_decode(F.substring(x, F.instr(x, "=") + 1,
                                                                          F.lit(1 << 30))).alias("v"))),
                    lambda p: (p["k"] == "v") & (p["v"] != ""))
    v = F.try_element_at(vals, F.lit(1))["v"]
    shorts = F.regexp_extract(url, r"youtube\.com/shorts/([^?&/]+)", 1)
    return (F.when(url.contains("youtu.be/"), tail)
            .when(v.isNotNull(), v)
            .when(shorts != "", shorts))


def source_id(canonical: Column) -> Column:
    """16-hex-char state id: the head of sha256(canonical_url)."""
    return F.substring(F.sha2(canonical, 256), 1, 16)


def cache_key(url: Column) -> Column:
    return F.sha2(url, 256)
