"""Operator 13: importance resampling towards a target distribution.

Features are all runs of up to ``longest_run`` consecutive words (A-Z
lower-cased), hashed into ``buckets`` buckets by CRC-32.  A bucket's gain is
the floored, scaled log ratio of its smoothed shares among the target texts
and among all documents.  A document's weight is the floored mean gain of its
features; Gumbel noise, taken from a hash of its id, turns the weights into
scores whose highest ``share`` percent are a draw without replacement.

Bit-sliced aggregation: a document's bucket counts are written as bit planes
(plane j holds a bit for each bucket whose count has bit j), the gains as bit
planes of their size, apart by sign.  The sum of count times gain is then

    sum over j, k of 2^(j+k) * (popcount(counts_j & up_k) - popcount(counts_j & down_k))

which is exact in 64-bit integers whatever the counts and signs.

Scale: two passes over the texts (bucket counts; weights), without a shuffle
of texts.  Bucket counts are summed in each task first: ``buckets`` rows a
task are shuffled.  Scores are integers of a bounded range (some hundred
thousand values), so one count per score gives the cut-off.  Only rows at or
above it are sorted, by range over all tasks, and numbered by the row's place
in its partition plus the rows of the partitions before.  Equal rows are told
apart by their place, so no key can fill one task.

Defined results: null and empty texts have no features, weight 0 and are not
drawn while ``min_words`` is positive; a null id counts as an empty text in
the hash, and comes last among equal scores; repeated rows are drawn each on
their own (rows of equal score and id are ordered by weight, then by number of
features); an empty target or table gives gains by the smoothing alone;
no columns but id and text are read, so other names cannot clash.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, checkpoint, flat_text, ranges, table, text_slices, word_spans

BUCKETS = 10_000
LONGEST_RUN = 1
SHARE = 10
MIN_WORDS = 20
SEED = 2024
#: Documents whose planes are held at a time.
PLANE_ROWS = 256
#: Spans longer than this are hashed one by one.
LONG_SPAN = 48


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_CRC = _crc_table()


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of each span of some bytes: a byte of all spans at a time."""
    size = ends - starts
    by = np.argsort(-size, kind="stable")
    starts, size = starts[by], size[by]
    crc = np.full(len(size), 0xFFFFFFFF, np.uint32)
    n_long = int(np.searchsorted(-size, -LONG_SPAN, side="left"))
    longer = np.searchsorted(-size, -np.arange(LONG_SPAN), side="left")  # spans of more than i bytes
    for i in range(min(LONG_SPAN, int(size.max(initial=0)))):
        part = slice(n_long, longer[i])
        c = crc[part]
        crc[part] = _CRC[(c ^ data[starts[part] + i]) & 0xFF] ^ (c >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for k in range(n_long):
        crc[k] = zlib.crc32(data[starts[k]:starts[k] + size[k]].tobytes())
    out = np.empty_like(crc)
    out[by] = crc
    return out


def features(arr: pa.Array, longest_run: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of every feature of some texts, and the words of each
    text."""
    data, offs = flat_text(arr)
    data = LOWER[data]
    s, e, ptr = word_spans(data, offs, ALNUM)
    words = np.diff(ptr)
    row = np.repeat(np.arange(len(words)), words)
    if longest_run > 1:  # words one space apart, so that runs are spans
        size = e - s
        s2 = np.cumsum(size + 1) - size - 1
        joined = np.full(int((size + 1).sum()), 0x20, np.uint8)
        joined[ranges(s2, size)] = data[ranges(s, size)]
        data, s, e = joined, s2, s2 + size
    rows, hashes = [], []
    for k in range(longest_run):
        here = slice(0, max(0, len(s) - k))
        same = row[here] == row[k:]
        rows.append(row[here][same])
        hashes.append(crc32_spans(data, s[here][same], e[k:][same]))
    return np.concatenate(rows), (np.concatenate(hashes) % np.uint32(buckets)).astype(np.int64), words


def bucket_counts(texts: DataFrame, text_col: str = "text", longest_run: int = LONGEST_RUN,
                  buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in text_slices(batch, "text"):
                n += np.bincount(features(part.column("text"), longest_run, buckets)[1], minlength=buckets)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["bucket", "n"])

    sums = (texts.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())  # at most `buckets` rows
    out = np.zeros(buckets, np.int64)
    out[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket from the counts among all documents and among
    the target texts."""
    n = len(raw)
    up, down = float(int(raw.sum()) + n), float(int(target.sum()) + n)
    return np.array([math.floor(1000 * math.log((t + 1.0) * up / ((s + 1.0) * down)))
                     for s, t in zip(raw.tolist(), target.tolist())], dtype=np.int64)


class GainPlanes:
    """Signed gains as bit planes, against bit planes of bucket counts."""

    def __init__(self, gain: np.ndarray):
        self.buckets = len(gain)
        self.width = -(-self.buckets // 64) * 64
        size = np.abs(gain)
        self.planes = []  # (factor, words)
        for k in range(int(size.max(initial=0)).bit_length()):
            bit = (size >> k & 1).astype(bool)
            for sign in (1, -1):
                on = bit & (np.sign(gain) == sign)
                if on.any():
                    self.planes.append((sign << k, self._packed(on[None, :])[0]))

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(bits), self.width), bool)
        wide[:, :bits.shape[1]] = bits
        return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)

    def sums(self, row: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        """The summed gains of the features of n texts; rows ascend."""
        total = np.zeros(n, np.int64)
        cut = np.searchsorted(row, np.arange(0, n + PLANE_ROWS, PLANE_ROWS))
        for at, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
            first = at * PLANE_ROWS
            cell, count = np.unique((row[a:b] - first) * self.width + bucket[a:b], return_counts=True)
            for j in range(int(count.max(initial=0)).bit_length()):
                mine = cell[(count >> j & 1).astype(bool)]
                texts, local = np.unique(mine // self.width, return_inverse=True)
                bits = np.zeros((len(texts), self.width), bool)
                bits[local, mine % self.width] = True
                plane = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
                for factor, gain in self.planes:
                    hits = np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64)
                    total[first + texts] += hits * (factor << j)
        return total


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
            longest_run: int = LONGEST_RUN) -> DataFrame:
    """doc_id, n_words, n_features and the floored mean gain of each row."""
    gain_b = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = GainPlanes(gain_b.value)
        for batch in batches:
            for part in text_slices(batch, "text"):
                row, bucket, words = features(part.column("text"), longest_run, planes.buckets)
                by = np.argsort(row, kind="stable")
                total = planes.sums(row[by], bucket[by], part.num_rows)
                n = np.bincount(row, minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words), pa.array(n), pa.array(total // np.maximum(n, 1))],
                    names=["doc_id", "n_words", "n_features", "weight"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, n_words long, n_features long, weight long"))


def noisy_score(weight: str, id_col: str, seed: int = SEED):
    """The weight plus Gumbel noise of the id, as an integer."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.col(weight) + F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def draw(scored: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` (doc_id, n_words, n_features, weight, score) with the rank
    of the drawn rows.  ``scored`` is read several times."""
    fit = scored.where(F.col("n_words") >= min_words)
    # one row for each score: integers of a bounded range
    per_score = sorted(fit.groupBy("score").count().collect(), reverse=True)
    left = drawn = share * sum(n for _, n in per_score) // 100
    lowest = None
    for value, n in per_score:
        if left <= 0:
            break
        lowest, left = value, left - n
    if lowest is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    key = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("weight"), F.asc("n_features"), F.asc("_place")]
    above = (F.col("n_words") >= min_words) & (F.col("score") >= lowest)
    top = scored.where(above).withColumn("_place", F.monotonically_increasing_id())
    top = checkpoint(top.repartitionByRange(*key).sortWithinPartitions(*key))
    top = top.withColumn("_place", F.monotonically_increasing_id())  # partition, and row in it
    sizes = dict(top.groupBy(F.shiftright("_place", 33).alias("p")).count().collect())
    before, at = [], 0
    for p in range(max(sizes) + 1):
        before.append(at)
        at += sizes.get(p, 0)
    place = F.element_at(F.lit(before), F.shiftright("_place", 33).cast("int") + 1) + (F.col("_place").bitwiseAND((1 << 33) - 1)) + 1
    ranked = top.withColumn("rank", F.when(place <= drawn, place)).drop("_place")
    return ranked.unionByName(scored.where(~above).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", longest_run: int = LONGEST_RUN, buckets: int = BUCKETS,
             share: int = SHARE, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document;
    those with a rank are the draw (see the module)."""
    if not 1 <= longest_run or not 1 <= buckets or not 0 <= share <= 100:
        raise ValueError("need longest_run >= 1, buckets >= 1 and a share of 0 to 100")
    gain = gains(bucket_counts(docs, text_col, longest_run, buckets),
                 bucket_counts(target, target_text_col, longest_run, buckets))
    scored = weights(docs, gain, id_col, text_col, longest_run)
    scored = checkpoint(scored.withColumn("score", noisy_score("weight", "doc_id", seed)))
    return draw(scored, share, min_words)


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of all ``documents``, drawn towards ``benchmark``."""
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
