"""Helpers shared by the operators of this package: whole-text word
segmentation on Arrow buffers, 64-bit content hashes, and small table
helpers.

Segmentation works on the bytes of a whole Arrow string column at once, so a
row costs no Python call.  Memory is bounded by working through a batch in
slices of a few MB of text; one text is never cut, so a single very long
text is a slice of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curation.session import ensure_checkpoint_dir

#: Text bytes that one slice of an Arrow batch holds.
SLICE_BYTES = 4 << 20

_U64 = (1 << 64) - 1
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark alone (any store Spark knows)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder of ``spark.checkpoint.dir`` and
    go on from the written rows (survives lost executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, what: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


# --- whole-text word segmentation -------------------------------------------

def byte_class(allowed) -> np.ndarray:
    """A 256-entry table: True for the bytes of words."""
    lut = np.zeros(256, dtype=bool)
    lut[list(allowed)] = True
    return lut


#: Words `[^\x20\x09-\x0D]+`.
NON_SPACE = byte_class(b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D)
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of text lower-cased A-Z.
ALNUM = byte_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def text_slices(batch: pa.RecordBatch, column: str,
                max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch between rows so that a slice holds about ``max_bytes``."""
    n = batch.num_rows
    if n == 0:
        return
    _, offs = flat_text(batch.column(batch.schema.get_field_index(column)))
    begin = 0
    while begin < n:
        end = int(np.searchsorted(offs, offs[begin] + max_bytes, side="right")) - 1
        end = min(max(end, begin + 1), n)
        yield batch.slice(begin, end - begin)
        begin = end


def flat_text(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets (null: empty)."""
    if arr.null_count:
        arr = arr.fill_null("")
    if pa.types.is_large_string(arr.type):
        kind = np.int64
    else:
        kind, arr = np.int32, arr.cast(pa.string())
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = arr.buffers()
    offs = np.frombuffer(bufs[1], kind)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def word_spans(data: np.ndarray, offs: np.ndarray, lut: np.ndarray):
    """Byte starts and ends of all words, and for each row the index of its
    first word (one entry more than rows)."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    w = lut[data]
    cut = np.zeros(n + 1, dtype=bool)  # a row begins here
    cut[offs] = True
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = False, w[:-1]
    starts = np.flatnonzero(w & (~before | cut[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = False, w[1:]
    ends = np.flatnonzero(w & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


# --- hashes ------------------------------------------------------------------

def mix64(x: np.ndarray) -> np.ndarray:
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n + 1, base, dtype=np.uint64)
    down = np.full(n + 1, pow(base, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def span_hasher(data: np.ndarray, seed: int = 0):
    """A function (starts, ends) -> 64-bit content hashes of spans of
    ``data`` (equal bytes, equal hash)."""
    up, down = _powers(((_BYTE_BASE + 2 * 0x1000193 * seed) & _U64) | 1, len(data))
    c = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1 + seed)) * up[:-1], out=c[1:])
    return lambda starts, ends: mix64((c[ends] - c[starts]) * down[starts])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                seed: int = 0) -> np.ndarray:
    """A 64-bit content hash of each word (equal bytes, equal hash)."""
    return span_hasher(data, seed)(starts, ends)


def window_hashes(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every ``k`` consecutive entries of ``h``."""
    if len(h) < k:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(((_WORD_BASE + 2 * 0x1000193 * seed) & _U64) | 1, len(h))
    c = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * up[:-1], out=c[1:])
    return mix64((c[k:] - c[:-k]) * down[:len(h) - k + 1])


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the number of them in each row."""
    offs = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offs[1:])
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(values, kind))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``start, start+1, ...`` of each range, one after the other."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    first = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - first, counts)


def flatten(parts):
    """All arrays of a list as one (an empty int64 array for none)."""
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def same_bits(col):
    """An unsigned 64-bit value kept as a long, as lower-case hex of 16."""
    return F.lower(F.lpad(F.hex(col), 16, "0"))
