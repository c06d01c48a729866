"""Operator 5: substring deduplication by relative Lempel-Ziv parsing.

Documents are parsed greedily against the texts of smaller ids: a factor
``(start, length, reference document, reference word)`` is the longest run
of words that goes on word for word in one reference.  Factors of at least
``window`` words are duplicate spans.  At a factor's end the parse looks back
over the boundary: a window that begins inside the factor and ends behind it
may lie in another reference, and then opens the next, overlapping factor.
So exactly the words are found that some window of ``window`` words covers
which also starts in a document with a smaller id.

The reference is indexed in blocks, one for each anchor.  The anchor of a
window is the smallest hash among its runs of ``SEED_WORDS`` words, so equal
windows have equal anchors, and a document needs to be parsed only against
the blocks of its own anchors: no other block can hold one of its windows.

1. One pass over the texts makes a digest of each text's words and its
   anchors (one for some 17 words).  Equal texts collapse to the smallest id;
   of the others everything goes (if they have a window at all).
2. Anchors met in two texts or more name the blocks that matter.
3. Texts with such anchors are read again; their windows in those blocks are
   indexed: the first (smallest) reference of each window.
4. Each of these texts meets the references of its own windows and is parsed.

Scale: a text crosses two shuffles at most, and only if it may have shared
anchors (a broadcast sieve of fixed size holds most others back).  All grouping is minima and maxima, which tasks combine first, so a
passage or text that a third of all documents hold ships one row per task;
the joins back are equi-joins against one row per key, which AQE can split.
Each text gathers its own windows only.  Window keys are 96 bits of hash.

Defined results: null and empty texts have no words; texts shorter than a
window keep all; rows with a null id keep all and are no reference; rows of
one id are never duplicates of each other, and each gets its own row; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (NON_SPACE, checkpoint, flat_text, list_column, ranges, table, text_slices, window_hashes,
                     word_hashes, word_spans)

WINDOW = 50
#: Words of the runs whose hashes are anchors.
SEED_WORDS = 18
#: Bits of the sieve of document ids (2 MB), a power of two.
SIEVE_BITS = 1 << 24


def sliding_minimum(h: np.ndarray, w: int) -> np.ndarray:
    """The smallest of every ``w`` consecutive values."""
    n = len(h) - w + 1
    if n <= 0:
        return h[:0]
    rows = np.append(h, np.full(-len(h) % w, np.iinfo(h.dtype).max, h.dtype)).reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def windows_of(texts: pa.Array, window: int, seed_words: int):
    """For the windows of some texts, in order: the text, the place (in
    words), the anchor, and the word hashes with each text's first word."""
    data, offs = flat_text(texts)
    s, e, ptr = word_spans(data, offs, NON_SPACE)
    h = word_hashes(data, s, e)
    n = np.maximum(np.diff(ptr) - window + 1, 0)
    at = ranges(ptr[:-1], n)
    row = np.repeat(np.arange(len(n)), n)
    anchor = sliding_minimum(window_hashes(h, seed_words), window - seed_words + 1)
    return row, at, anchor[at] if len(at) else np.zeros(0, np.uint64), h, ptr


def window_keys(h: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of hash of the windows at the places ``at``."""
    a = window_hashes(h, window)[at].view(np.int64)
    b = (window_hashes(h, window, seed=1)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return a, b


def _survey(window: int, seed_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                row, _, anchor, _, ptr = windows_of(part.column("text"), window, seed_words)
                by = np.lexsort((anchor, row))
                row, anchor = row[by], anchor[by]
                new = np.append(True, (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1]))[:len(row)]
                count = np.bincount(row[new], minlength=part.num_rows)
                digest = [_digest(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array(np.diff(ptr)), pa.array(digest, pa.binary()),
                    list_column(anchor[new].view(np.int64), count, pa.int64())],
                    names=["id", "n_words", "digest", "anchors"])

    return run


def _digest(text: str | None) -> bytes:
    return hashlib.sha256(b" ".join((text or "").encode().split())).digest()


def _own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows whose text has the digest beside it: several texts of one id
    meet each other's digests."""
    for batch in batches:
        own = [_digest(t) == d for t, d in zip(batch.column("text").to_pylist(), batch.column("digest").to_pylist())]
        yield batch.select(["id", "text", "digest", "shared"]).filter(pa.array(own, pa.bool_()))


def _index(window: int, seed_words: int):
    """The windows of texts in the blocks of shared anchors, once a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                row, at, anchor, h, ptr = windows_of(part.column("text"), window, seed_words)
                shared = np.unique(part.column("shared").flatten().to_numpy(zero_copy_only=False)).view(np.uint64)
                hit = np.isin(anchor, shared)
                row, at = row[hit], at[hit]
                a, b = window_keys(h, at, window)
                by = np.lexsort((at, b, a, row))
                row, at, a, b = row[by], at[by], a[by], b[by]
                new = np.append(True, (row[1:] != row[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[:len(row)]
                row, at, a, b = row[new], at[new], a[new], b[new]
                for x in range(0, len(row), 1 << 18):
                    z = slice(x, x + (1 << 18))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(a[z]), pa.array(b[z]), part.column("id").take(pa.array(row[z])),
                        pa.array((at[z] - ptr[row[z]]).astype(np.int32))], names=["a", "b", "id", "at"])

    return run


def parse(place: np.ndarray, ref: np.ndarray, ref_at: np.ndarray, window: int):
    """Factors of a document from its windows that a smaller document has:
    their places (ascending) and first references.  A factor goes on while
    the next window goes on in the same reference; the window behind its end
    that lies elsewhere opens the next one, over the boundary."""
    if not len(place):
        z = np.zeros(0, np.int64)
        return z, z, z, z
    new = np.append(True, (np.diff(place) != 1) | (np.diff(ref) != 0) | (np.diff(ref_at) != 1))
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(place))) + window - 1
    return place[first], length, ref[first], ref_at[first]


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """The words that spans cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


def _factor(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "ref", "ref_start")]))
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                data, offs = flat_text(part.column("text"))
                s, e, ptr = word_spans(data, offs, NON_SPACE)
                h = word_hashes(data, s, e)
                n = np.maximum(np.diff(ptr) - window + 1, 0)
                a, b = window_keys(h, ranges(ptr[:-1], n), window)
                ends = np.cumsum(n)
                removed, digest, factors, kept = [], [], [], []
                firsts = part.column("firsts")
                for i, text in enumerate(part.column("text").to_pylist()):
                    f = firsts[i].values
                    fa, fb, fr, ft = (f.field(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "ref", "ref_at"))
                    by = np.lexsort((fb, fa))
                    own = slice(ends[i] - n[i], ends[i])
                    # binary search by the first key, then over its few equals
                    k = np.searchsorted(fa[by], a[own])
                    top = np.searchsorted(fa[by], a[own], side="right")
                    hit = np.full(len(k), -1)
                    while True:
                        live = k < top
                        if not live.any():
                            break
                        here = by[np.where(live, k, 0)]
                        same = live & (fb[here] == b[own])
                        hit[same] = here[same]
                        k = np.where(same, top, k + 1)
                    place = np.flatnonzero(hit >= 0)
                    fs, fl, rr, rs = parse(place, fr[hit[place]], ft[hit[place]].astype(np.int64), window)
                    words = text.encode().split()
                    gone = covered(fs, fl, len(words))
                    keep = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                    removed.append(int(gone.sum()))
                    digest.append(hashlib.sha256(keep).hexdigest())
                    kept.append(keep.decode())
                    factors.append([dict(zip(("start", "length", "ref", "ref_start"), x))
                                    for x in zip(fs.tolist(), fl.tolist(), rr.tolist(), rs.tolist())])
                yield pa.RecordBatch.from_arrays([
                    part.column("digest"), pa.array(removed, pa.int64()), pa.array(digest), pa.array(kept),
                    pa.array(factors, kind)], names=["digest", "n_removed", "kept_sha256", "kept", "factors"])

    return run


_FACTORED = ("digest binary, n_removed long, kept_sha256 string, kept string, "
             "factors array<struct<start:long,length:long,ref:long,ref_start:long>>")


def _slot(id_col: str):
    return F.pmod(F.xxhash64(id_col), F.lit(SIEVE_BITS))


def _maybe_in(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """``texts`` without most of those whose id is not among ``ids``: a sieve
    of ``SIEVE_BITS`` bits, broadcast as bitmaps.  It lets through all that
    are among them, and spares the others the shuffle.  With many more ids
    than bits it lets all through."""
    bitmap_bits = 8 * 4096  # of Spark's bitmap functions
    slot = _slot(ids.columns[0])
    sieve = (ids.select((slot / bitmap_bits).cast("long").alias("_map"), (slot % bitmap_bits).alias("_bit"))
             .groupBy("_map").agg(F.bitmap_construct_agg("_bit").alias("_bits")))
    at = (_slot("id") % bitmap_bits).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return (texts.withColumn("_map", (_slot("id") / bitmap_bits).cast("long"))
            .join(F.broadcast(sieve), "_map")  # SIEVE_BITS / 8 bytes at most
            .where(F.floor(byte / F.pow(F.lit(2.0), at % 8)) % 2 == 1)
            .drop("_map", "_bits"))


def factor(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
           seed_words: int = SEED_WORDS) -> tuple[DataFrame, DataFrame]:
    """``(rows, parsed)``: for every row id, n_words, digest, ``first_id``
    (the smallest id of its text), n_removed, kept_sha256 and factors (null
    where nothing was found); and for the texts with factors, by digest, the
    same with kept (the text left)."""
    if not 0 < seed_words <= window:
        raise ValueError("need 0 < seed_words <= window")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    survey = checkpoint(texts.mapInArrow(_survey(window, seed_words),
                                         "id long, n_words long, digest binary, anchors array<long>"))
    one = checkpoint(survey.where("id is not null").groupBy("digest").agg(F.min(F.struct("id", "anchors")).alias("m"))
                     .select("digest", "m.id", "m.anchors"))
    # two texts of one id are told apart by their digests; references need another id
    placed = one.select("digest", "id", F.explode("anchors").alias("anchor"))
    shared = checkpoint(placed.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
                        .where("lo < hi").select("anchor"))
    wanted = placed.join(shared, "anchor").groupBy("digest", "id").agg(F.collect_list("anchor").alias("shared"))
    wanted = wanted.withColumnRenamed("id", "_id")
    wanted = checkpoint(wanted)
    source = checkpoint(_maybe_in(texts, wanted.select("_id")).join(wanted, F.col("id") == F.col("_id")).drop("_id")
                        .mapInArrow(_own_text, "id long, text string, digest binary, shared array<long>"))
    index = source.select("id", "text", "shared").mapInArrow(_index(window, seed_words),
                                                            "a long, b int, id long, at int")
    first = checkpoint(index.groupBy("a", "b").agg(F.min(F.struct("id", "at")).alias("first"), F.max("id").alias("hi"))
                       .where("first.id < hi")
                       .select("a", "b", F.col("first.id").alias("ref"), F.col("first.at").alias("ref_at")))
    met = (index.join(first, ["a", "b"]).where("ref < id").groupBy("id")
           .agg(F.collect_list(F.struct("a", "b", "ref", "ref_at")).alias("firsts"))
           .withColumnRenamed("id", "_id"))
    parsed = (source.join(met, source["id"] == met["_id"]).select("digest", "text", "firsts")
              .mapInArrow(_factor(window), _FACTORED))
    # rows that repeat an id and its text were parsed each
    facts = checkpoint(one.select("digest", F.col("id").alias("first_id"))
                       .join(parsed.drop("kept").dropDuplicates(["digest"]), "digest", "left"))
    return survey.select("id", "n_words", "digest").join(facts, "digest", "left"), parsed


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                seed_words: int = SEED_WORDS) -> DataFrame:
    """For every row: id, n_words, n_removed, kept_sha256, factors (null where
    the whole text is the copy of a smaller id's)."""
    out, _ = factor(docs, id_col, text_col, window, seed_words)
    own = F.lower(F.hex("digest"))
    copy = (F.col("id") > F.col("first_id")) & (F.col("n_words") >= window)
    # a null id has no smaller one
    lone = F.col("id").isNull()
    return out.select(
        "id", "n_words",
        F.when(copy, F.col("n_words")).when(lone, 0).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).when(lone, own)
        .otherwise(F.coalesce("kept_sha256", own)).alias("kept_sha256"),
        F.when(~copy & ~lone, F.col("factors")).alias("factors"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``, windows of 50 words."""
    out = deduplicate(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")
