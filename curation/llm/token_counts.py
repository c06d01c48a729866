"""Operator 7: token counts of sections by offset-mapped attribution.

A whole document is encoded once.  Every token covers a span of it; the spans
are joined with the spans of the document's sections (lines, or the fields
that were put together) by binary search of the section starts.  A token that
crosses a boundary is allocated by an explicit rule:

- ``first``: the section in which it begins gets all of it;
- ``last``: the section in which it ends gets all of it;
- ``share``: each section gets the share of the token's bytes that it holds.

The counts of a document's sections always add up to its tokens.

Scale: documents never leave the task that reads them; one task holds one
document's tokens at a time.  No shuffle, no broadcast.

Defined results: a null or empty text is one empty section without tokens;
null fields are empty; repeated rows are counted each time; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import flatten, table, text_slices

RULES = ("first", "last", "share")
COUNTS = ("doc_id long, section int, char_start long, char_end long, n_tokens double, "
          "n_crossing long, doc_tokens long")


def load_ranks(path: str) -> dict[bytes, int]:
    """The byte strings of a ``.tiktoken`` vocabulary and their ids."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def token_bytes(ranks: dict[bytes, int]) -> np.ndarray:
    """The number of bytes of each token id."""
    n = np.zeros(max(ranks.values()) + 1, np.int64)
    for t, i in ranks.items():
        n[i] = len(t)
    return n


def attribute(n_bytes: np.ndarray, starts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section and tokens that begin in it and end beyond it.
    ``n_bytes``: bytes of the document's tokens in order; ``starts``: where
    each section begins (from 0, ascending; equal starts: empty sections)."""
    ends = np.cumsum(n_bytes)
    begins = ends - n_bytes
    k = len(starts)
    first = np.searchsorted(starts, begins, side="right") - 1
    last = np.searchsorted(starts, ends - 1, side="right") - 1
    crossing = np.bincount(first[first != last], minlength=k)
    if rule == "first":
        return np.bincount(first, minlength=k).astype(float), crossing
    if rule == "last":
        return np.bincount(last, minlength=k).astype(float), crossing
    whole = first == last
    out = np.bincount(first[whole], minlength=k).astype(float)
    for b, e in zip(begins[~whole].tolist(), ends[~whole].tolist()):
        lo, hi = np.searchsorted(starts, [b, e - 1], side="right") - 1
        edges = np.clip(np.append(starts[lo + 1:hi + 1], e), b, e)
        out[lo:hi + 1] += np.diff(edges, prepend=b) / (e - b)
    return out, crossing


def _count(path: str, pattern: str, rule: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = load_ranks(path)
        enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        size = token_bytes(ranks)
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids, sections, spans, counts, crossing, totals = [], [], [], [], [], []
                for doc, text, cuts in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "cuts"))):
                    raw = text.encode()
                    n = size[np.array(enc.encode_ordinary(text), dtype=np.int64)] if raw else np.zeros(0, np.int64)
                    b = np.frombuffer(raw, np.uint8)
                    chars = np.append(0, np.cumsum((b & 0xC0) != 0x80))
                    starts = np.array(cuts, np.int64) if cuts is not None else \
                        np.append(0, np.flatnonzero(b == 0x0A) + 1)
                    t, c = attribute(n, starts, rule)
                    at = chars[np.append(starts, len(raw))]
                    ids += [doc] * len(starts)
                    sections.append(np.arange(len(starts)))
                    spans.append(np.stack([at[:-1], at[1:]]))
                    counts.append(t)
                    crossing.append(c)
                    totals.append(np.full(len(starts), len(n)))
                a, z = np.concatenate(spans, axis=1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(flatten(sections), pa.int32()), pa.array(a), pa.array(z),
                    pa.array(flatten(counts)), pa.array(flatten(crossing), pa.int64()),
                    pa.array(flatten(totals), pa.int64())],
                    names=[x.split()[0] for x in COUNTS.split(", ")])

    return run


def count_tokens(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                 text_col: str = "text", fields: list[str] | None = None, joiner: str = "\n",
                 rule: str = "first") -> DataFrame:
    """Tokens of each section: doc_id, section (from 0), char_start, char_end
    (end exclusive), n_tokens, n_crossing, doc_tokens.

    Sections are the lines of ``text_col``, each with its line end; with
    ``fields``, the document is those columns put together by ``joiner`` and
    each field, with the joiner behind it, is a section."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    if fields:
        full = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
        parts = [F.concat(c, F.lit(joiner)) for c in full[:-1]] + full[-1:]
        text, at, cuts = F.concat(*parts), F.lit(0), []
        for p in parts:
            cuts.append(at)
            at = at + F.octet_length(p)
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                           F.array(*cuts).cast("array<long>").alias("cuts"))
    else:
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                           F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                           F.lit(None).cast("array<long>").alias("cuts"))
    return rows.mapInArrow(_count(ranks_path, pattern, rule), COUNTS)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of all ``documents``, by the first-character rule."""
    import public_tokenizers as public

    return count_tokens(table(spark, sf_dir, "documents"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
