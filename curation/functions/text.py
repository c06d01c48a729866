"""Text column expressions that follow Python ``str`` semantics on the JVM.

Python's ``str.isspace`` / ``\\s`` / ``strip`` / ``splitlines`` are Unicode
aware and differ from Java's ``\\s`` and Spark's ``trim`` (spaces only).  The
character classes below are the exact Python sets, written as Java regex.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts (Python 3.13).
PY_SPACE_CODEPOINTS = [
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
    (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
    (0x3000, 0x3000),
]
# Line boundaries of Python's str.splitlines() ("\r\n" counts once).
PY_LINE_BREAK_CODEPOINTS = [
    (0x0A, 0x0D), (0x1C, 0x1E), (0x85, 0x85), (0x2028, 0x2029),
]


def _java_class(ranges, negate_from=None) -> str:
    parts = []
    for lo, hi in ranges:
        parts.append(f"\\x{{{lo:X}}}" if lo == hi else f"\\x{{{lo:X}}}-\\x{{{hi:X}}}")
    return "[" + "".join(parts) + "]"


def _minus(a, b):
    """Code points in ranges ``a`` but not in ``b`` (small sets only)."""
    sa = {c for lo, hi in a for c in range(lo, hi + 1)}
    sb = {c for lo, hi in b for c in range(lo, hi + 1)}
    out = sorted(sa - sb)
    ranges = []
    for c in out:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1] = (ranges[-1][0], c)
        else:
            ranges.append((c, c))
    return ranges


SPACE = _java_class(PY_SPACE_CODEPOINTS)
LINE_BREAK = _java_class(PY_LINE_BREAK_CODEPOINTS)
INLINE_SPACE = _java_class(_minus(PY_SPACE_CODEPOINTS, PY_LINE_BREAK_CODEPOINTS))
# "\r\n" first so that it counts as one boundary.
LINE_BREAK_SEQ = "\\r\\n|" + LINE_BREAK


# The same set as a plain string of characters (for ``trim(str, chars)``).
SPACE_CHARS = "".join(chr(c) for lo, hi in PY_SPACE_CODEPOINTS for c in range(lo, hi + 1))


def py_strip(c: Column) -> Column:
    """Python ``str.strip()`` (Unicode whitespace on both ends).

    ``trim(str, chars)`` removes any of the given characters from both ends
    in one pass over the ends only (no regex over the whole text)."""
    return F.trim(c, F.lit(SPACE_CHARS))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a lambda), e.g. when
    an expensive array is used several times; lambda bodies are not covered
    by common-subexpression elimination."""
    return F.element_at(F.transform(F.array(value), body), 1)


def collapse_ws(c: Column) -> Column:
    """``re.sub(r"\\s+", " ", s).strip()``."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def clean_lines(c: Column) -> Column:
    r"""Per line: collapse whitespace and strip; drop blank lines; join by "\n".

    Equals ``"\n".join(l for l in (re.sub(r"\s+"," ",x).strip()
    for x in s.splitlines()) if l)`` without materialising an array: a
    whitespace run that holds a line break becomes one "\n", any other run
    one space, then the ends are trimmed.
    """
    t = F.regexp_replace(c, f"{INLINE_SPACE}*(?:{LINE_BREAK}{INLINE_SPACE}*)+", "\n")
    t = F.regexp_replace(t, f"{INLINE_SPACE}+", " ")
    return F.trim(t, F.lit(" \n"))


def utf16_length(c: Column) -> Column:
    """Length in UTF-16 code units (JavaScript ``.length``)."""
    return (F.octet_length(F.encode(c, "UTF-16BE")) / 2).cast("int")


def approx_tokens(title: Column, body: Column) -> Column:
    """``max(1, (len(title + "\\n" + body) + 3) // 4)``."""
    n = F.length(F.coalesce(title, F.lit(""))) + 1 + F.length(F.coalesce(body, F.lit("")))
    return F.greatest(F.lit(1), F.floor((n + 3) / 4).cast("int"))


def excerpt(text: Column, token_limit: Column) -> Column:
    """Body excerpt: limit max(120, 4*tokens) chars, cut back to the last space.

    ``clean[:limit].rsplit(" ", 1)[0].rstrip() + "..."`` when too long.
    """
    limit = F.greatest(F.lit(120), token_limit * 4)
    clean = F.regexp_replace(py_strip(F.coalesce(text, F.lit(""))), "\n{3,}", "\n\n")
    head = F.substring(clean, F.lit(1), limit)
    # rsplit(" ", 1)[0]: everything before the last space (whole head if none)
    before_space = F.when(F.instr(head, " ") > 0,
                          F.regexp_extract(head, "(?s)^(.*) ", 1)).otherwise(head)
    cut = F.regexp_replace(before_space, f"{SPACE}+$", "")
    return F.when(F.length(clean) <= limit, clean).otherwise(F.concat(cut, F.lit("...")))
