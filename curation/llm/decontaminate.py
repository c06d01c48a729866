"""Operator 10: benchmark decontamination by training suffix arrays.

The training texts are cut into shards (runs of whole documents of a few
million bytes, inside one task).  For every shard the suffix array over its
words is built by prefix doubling; only suffixes that still tie are sorted
again, and no deeper than the longest test item.  Every suffix of the test
items is then searched in every shard by binary search, one word deeper at a
time, all suffixes at once.  This gives for each test suffix its longest
verbatim match and all places of it.  A document word that a whole window of
``window`` item words covers is hit; affected documents can be dropped.

Scale: training texts never leave the task that reads them: no shuffle, and
memory for one shard.  The test items are broadcast in blocks of a checked
size; each block is one more pass over the shards (a stated query set against
all rows).  A shard's hits are reduced to rows of its own documents, so a
copy group or a common passage gives no pairs.

Defined results: null and empty texts have no words and are never hit; an
item without words is no window; an item of fewer words than a window is one
window; repeated items count once by id, and an item with a null id hits
words but is not listed; other columns pass unchanged; an empty table on
either side gives no hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (ALNUM, LOWER, checkpoint, flat_text, flatten, list_column, ranges, table,
                     text_slices, word_hashes, word_spans)

WINDOW = 10
#: Text bytes of one shard, and of one broadcast block of test items.
SHARD_BYTES = 6 << 20
BLOCK_BYTES = 8 << 20

_SPANS = ("_hit_from", "_hit_to", "_hit_items")
_MARKS = {"_mark_n_words": T.LongType(), "_mark_n_hit": T.LongType(), "_mark_n_items": T.LongType(),
          "_mark_items_sha256": T.StringType(), "_mark_contaminated": T.BooleanType()}


def words(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a text column with a 0 behind each text, and the index
    at which each text begins (one entry more than texts)."""
    data, offs = flat_text(arr)
    data = LOWER[data]
    s, e, ptr = word_spans(data, offs, ALNUM)
    h = word_hashes(data, s, e)
    h[h == 0] = 1
    n = len(ptr) - 1
    out = np.zeros(len(h) + n, np.uint64)
    out[np.arange(len(h)) + np.repeat(np.arange(n), np.diff(ptr))] = h
    return out, ptr + np.arange(n + 1)


def suffix_array(ranks: np.ndarray, depth: int) -> np.ndarray:
    """Suffix order of ``ranks`` (0 and up) by their first ``depth`` entries
    at least."""
    n = len(ranks)
    order = np.argsort(ranks, kind="stable")
    rank = np.empty(n, np.int64)  # of a suffix: where its group begins in the order

    def group(slots, items, keys):
        new = np.empty(len(slots), bool)
        new[:1] = True
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        rank[items] = np.repeat(slots[first], np.diff(np.append(first, len(slots))))
        single = new & np.append(new[1:], True)
        return slots[~single]

    tied = group(np.arange(n), order, ranks[order])
    length = 1
    while length < depth and len(tied):
        items = order[tied]
        ahead = items + length
        behind = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        keys = (rank[items].astype(np.uint64) << np.uint64(32)) | behind.astype(np.uint64)
        by = np.argsort(keys, kind="stable")
        items, keys = items[by], keys[by]
        order[tied] = items
        tied = group(tied, items, keys)
        length *= 2
    return order


def _bound(seq, order, lo, hi, depth, target, right):
    """The first place in [lo, hi) of each range whose suffix has at
    ``depth`` a word not below (``right``: above) the target."""
    lo, hi = lo.copy(), hi.copy()
    last = len(seq) - 1
    while True:
        live = lo < hi
        if not live.any():
            return lo
        mid = (lo + hi) >> 1
        at = order[np.where(live, mid, 0)] + depth
        w = np.where(at <= last, seq[np.minimum(at, last)], 0)
        up = live & ((w <= target) if right else (w < target))
        lo = np.where(up, mid + 1, lo)
        hi = np.where(live & ~up, mid, hi)


def search(seq: np.ndarray, order: np.ndarray, test: np.ndarray, suffixes: np.ndarray,
           need: np.ndarray):
    """Binary-search the suffixes of ``test`` (ranks; 0 ends an item, -1 is
    unknown to the shard).  Returns for each the longest match, its range in
    the suffix array, and the range at the depth that it needs (empty if the
    match is shorter)."""
    n = len(suffixes)
    lo, hi = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    longest, best = np.zeros(n, np.int64), np.zeros((2, n), np.int64)
    at_need = np.zeros((2, n), np.int64)
    live = np.arange(n)
    depth = 0
    while len(live):
        target = test[suffixes[live] + depth]
        live, target = live[target > 0], target[target > 0]
        a = _bound(seq, order, lo[live], hi[live], depth, target, False)
        b = _bound(seq, order, a, hi[live], depth, target, True)
        found = a < b
        live, a, b = live[found], a[found], b[found]
        depth += 1
        lo[live], hi[live], longest[live] = a, b, depth
        best[0, live], best[1, live] = a, b
        done = live[need[live] == depth]
        at_need[0, done], at_need[1, done] = lo[done], hi[done]
    return longest, best, at_need


class Items:
    """A block of test items: their words, and what each suffix needs."""

    def __init__(self, rows: list, window: int):
        self.ids = [None if r[0] is None else str(r[0]) for r in rows]
        self.words, begin = words(pa.array([r[1] for r in rows], pa.string()))
        n = np.diff(begin) - 1
        self.suffixes = ranges(begin[:-1], n)
        self.item = np.repeat(np.arange(len(rows)), n)
        left = np.repeat(begin[1:] - 1, n) - self.suffixes
        short = np.repeat((n < window) & (n > 0), n) & (self.suffixes == np.repeat(begin[:-1], n))
        # windows start where enough words follow; a short item is one window
        self.need = np.where(left >= window, window, np.where(short, left, -1))
        self.depth = int(n.max(initial=1))


def shard_matches(items: Items, arr: pa.Array):
    """Search a block of items in one shard.  Returns the shard's words, the
    begins of its texts, and the parts of ``search``."""
    train, begin = words(arr)
    known = np.unique(train)
    seq = np.searchsorted(known, train)
    if not len(known) or known[0] != 0:
        seq += 1
    else:
        known = known[1:]
    where = np.searchsorted(known, items.words)
    hit = (where < len(known)) & (known[np.minimum(where, max(len(known) - 1, 0))] == items.words) \
        if len(known) else np.zeros(len(where), bool)
    test = np.where(items.words == 0, 0, np.where(hit, where + 1, -1))
    order = suffix_array(seq, items.depth + 1)
    return train, begin, order, search(seq, order, test, items.suffixes, items.need)


def _hits(items: Items, arr: pa.Array):
    """For the texts of a shard: hit word spans and items, as flat arrays with
    counts per text."""
    _, begin, order, (_, _, (lo, hi)) = shard_matches(items, arr)
    n = len(begin) - 1
    which = np.flatnonzero(hi > lo)
    size = hi[which] - lo[which]
    place = order[ranges(lo[which], size)]
    suffix = np.repeat(which, size)
    doc = np.searchsorted(begin, place, side="right") - 1
    start = place - begin[doc]
    span = np.unique(np.stack([doc, start, start + items.need[suffix]], 1), axis=0) if len(doc) \
        else np.zeros((0, 3), np.int64)
    pair = np.unique(doc * max(len(items.ids), 1) + items.item[suffix])
    pdoc, pitem = pair // max(len(items.ids), 1), pair % max(len(items.ids), 1)
    return span, np.bincount(span[:, 0], minlength=n), pitem, np.bincount(pdoc, minlength=n), \
        np.diff(begin) - 1


def _pass(items_b, text_col: str, keep: list[str], last: bool, window: int):
    """One block of items against all shards of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(items_b.value, window)
        for batch in batches:
            for part in text_slices(batch, text_col, SHARD_BYTES):
                old = {c: part.column(part.schema.get_field_index(c)) for c in _SPANS}
                span, n_span, pitem, n_pair, n_words = _hits(items, part.column(
                    part.schema.get_field_index(text_col)))
                ids = [items.ids[k] for k in pitem.tolist()]
                # what earlier blocks found stands before this block's
                rows = []
                s, p = np.append(0, np.cumsum(n_span)), np.append(0, np.cumsum(n_pair))
                a, b, c = (old[x].to_pylist() for x in _SPANS)
                for i in range(part.num_rows):
                    x, y = slice(s[i], s[i + 1]), slice(p[i], p[i + 1])
                    if not last or a[i] or s[i] < s[i + 1]:
                        rows.append((np.append(a[i], span[x, 1]).astype(np.int64),
                                     np.append(b[i], span[x, 2]).astype(np.int64),
                                     sorted({*c[i], *(z for z in ids[y] if z is not None)})))
                    else:
                        rows.append(None)
                kept = [part.column(part.schema.get_field_index(c)) for c in keep]
                names = list(keep)
                if last:
                    cols = _summary(rows, n_words)
                    names += _MARKS
                else:
                    cols = [list_column(flatten([r[k] for r in rows]),
                                        np.array([len(r[k]) for r in rows]), pa.int64()) for k in (0, 1)]
                    cols.append(pa.array([r[2] for r in rows], pa.list_(pa.string())))
                    names += _SPANS
                yield pa.RecordBatch.from_arrays(kept + cols, names=names)

    return run


_NO_ITEMS = hashlib.sha256(b"").hexdigest()


def _summary(rows: list, n_words: np.ndarray) -> list[pa.Array]:
    hit, count, digest = [], [], []
    for r in rows:
        if r is None or not len(r[0]):
            hit.append(0), count.append(0), digest.append(_NO_ITEMS)
            continue
        by = np.argsort(r[0], kind="stable")
        a, b = r[0][by], np.maximum.accumulate(r[1][by])
        free = np.maximum(a, np.append(0, b[:-1]))
        hit.append(int(np.maximum(b - free, 0).sum()))
        count.append(len(r[2]))
        digest.append(hashlib.sha256(",".join(r[2]).encode()).hexdigest())
    return [pa.array(n_words, pa.int64()), pa.array(hit, pa.int64()), pa.array(count, pa.int64()),
            pa.array(digest, pa.string()), pa.array([h > 0 for h in hit], pa.bool_())]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    """The test items in parts of about ``block_bytes`` of text."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    if n == 1:
        return [rows]
    rows = checkpoint(rows)
    return [rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) for k in range(n)]


def _marked(docs: DataFrame, benchmark: DataFrame, text_col: str, item_id: str, item_text: str,
            window: int, block_bytes: int) -> DataFrame:
    """``docs`` with the columns of ``_MARKS`` behind its own."""
    sc = docs.sparkSession.sparkContext
    keep, kinds = docs.columns, list(docs.schema)
    spans = [T.StructField(c, T.ArrayType(T.LongType())) for c in _SPANS[:2]]
    spans.append(T.StructField(_SPANS[2], T.ArrayType(T.StringType())))
    out = T.StructType(kinds + [T.StructField(c, k) for c, k in _MARKS.items()])
    now = docs.select("*", *(F.array().cast(f.dataType).alias(f.name) for f in spans))
    blocks = _blocks(benchmark, item_id, item_text, block_bytes)
    for k, block in enumerate(blocks):
        items = sc.broadcast([tuple(r) for r in block.toLocalIterator()])
        last = k == len(blocks) - 1
        now = now.mapInArrow(_pass(items, text_col, keep, last, window),
                             out if last else T.StructType(kinds + spans))
    return now


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                       item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256 and contaminated
    (own columns of those names are replaced)."""
    names = {m: m.removeprefix("_mark_") for m in _MARKS}
    found = _marked(docs, benchmark, text_col, item_id, item_text, window, block_bytes)
    return found.select(*(c for c in docs.columns if c not in names.values()),
                        *(F.col(m).alias(n) for m, n in names.items()))


def longest_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                    least: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For every shard, the longest verbatim match of each test suffix that
    has ``least`` words or more, once per place: item_id, item_word (where
    the suffix begins), length, doc_id, doc_word."""
    sc = docs.sparkSession.sparkContext

    def run(items_b):
        def f(batches):
            items = Items(items_b.value, least)
            for batch in batches:
                for part in text_slices(batch, "text", SHARD_BYTES):
                    _, begin, order, (longest, (lo, hi), _) = shard_matches(items, part.column("text"))
                    which = np.flatnonzero(longest >= least)
                    size = hi[which] - lo[which]
                    place = order[ranges(lo[which], size)]
                    suffix = np.repeat(which, size)
                    doc = np.searchsorted(begin, place, side="right") - 1
                    first = np.searchsorted(items.item, items.item[suffix])
                    yield pa.RecordBatch.from_arrays([
                        pa.array([items.ids[k] for k in items.item[suffix].tolist()], pa.string()),
                        pa.array(suffix - first, pa.int64()), pa.array(longest[suffix], pa.int64()),
                        part.column("doc_id").take(pa.array(doc)), pa.array(place - begin[doc], pa.int64()),
                    ], names=["item_id", "item_word", "length", "doc_id", "doc_word"])
        return f

    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for block in _blocks(benchmark, item_id, item_text, block_bytes):
        items = sc.broadcast([tuple(r) for r in block.toLocalIterator()])
        now = rows.mapInArrow(run(items), "item_id string, item_word long, length long, "
                                          "doc_id string, doc_word long")
        out = now if out is None else out.unionByName(now)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  window: int = WINDOW) -> DataFrame:
    """The documents without any hit word, with their own columns."""
    found = _marked(docs, benchmark, text_col, "item_id", "text", window, BLOCK_BYTES)
    return found.where("not _mark_contaminated").select(*docs.columns)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` against all ``benchmark`` items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.drop("text")


OP10_SQL = r"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
asked AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 10) AS k FROM asked WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized)),
places AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM lowered, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
found AS (SELECT doc_id, k, i, item_id FROM places JOIN windows USING (k, win)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM lowered LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
