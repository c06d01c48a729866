"""Operator 1: packing by an order-preserving dynamic program.

Every document becomes its token ids followed by the end id.  The ids of a
partition stand in one stream, in order.  The stream is cut into windows of
at most ``window`` ids.  A cut may fall at a document end (free), at a
sentence end (costs ``sentence_penalty``) or, every ``grid`` ids, inside a
sentence (costs ``inside_penalty``).  The dynamic program

    best[j] = min over i with pos[j] - pos[i] <= window of
              best[i] + padding(pos[j] - pos[i]) + penalty[j]

finds the cheapest cuts.  As padding is ``window - (pos[j] - pos[i])``, the
minimum of ``best[i] + pos[i]`` over a sliding range of i is wanted, which a
monotone queue keeps in constant time per cut point.  A window whose length
is a power of two needs no padding; the powers from half of the window on
(shorter windows are not wanted) are looked up beside the queue.

Bounded memory: the program runs over blocks of about ``block`` ids.  All
but the last windows of a block are final; the rest of the ids opens the
next block.  A document longer than a block is spread over several.

Tokens: chunks between which the tokenizer always cuts are encoded on their
own, each distinct chunk once per task.  The tokenizer never merges over
such a cut, so this gives the ids of the whole text (tests hold it against
the tokenizer).

Defined results: a null or empty text is the end id alone; repeated rows are
packed each time; an empty table gives no rows; other columns are ignored.
A null id column is carried as null.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import LOWER, NON_SPACE, flat_text, ranges, span_hasher, table, text_slices

WINDOW = 2048
END_ID = 1
SENTENCE_PENALTY = 8
INSIDE_PENALTY = 48
GRID = 64
BLOCK = 1 << 18
#: Distinct chunks that a task keeps encoded.
CACHE_CHUNKS = 300_000

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


#: Classes of bytes: white space and controls 0, others (non-ASCII) are not cut.
_LETTER, _DIGIT, _SIGN, _OTHER = 1, 2, 3, 4
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[0x80:] = _OTHER


def _grown(a: np.ndarray, n: int) -> np.ndarray:
    """``a``, doubled if it holds fewer than ``n`` entries."""
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n - len(a), len(a)), a.dtype)])


class ChunkEncoder:
    """Token ids of texts by a cache of encoded chunks.

    Chunks are cut at ASCII white space, and between an ASCII or Latin-1
    letter, a digit and an ASCII sign, where the tokenizer cuts as well.  No
    cut stands between an apostrophe and what follows it (``'s`` is one
    piece).  A-Z are lower-cased unless a non-ASCII byte follows, which might
    compose with the letter.  A slice that may hold a special token's text is
    cut at white space alone.
    """

    def __init__(self, path: str, limit: int = CACHE_CHUNKS):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.limit = limit
        self._clear()
        vocab = self.tok.get_vocab()
        self.sentence_end = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.word_end = self.sentence_end.copy()
        for t, i in vocab.items():
            if t.endswith("</w>"):
                self.word_end[i] = True
                self.sentence_end[i] = t[:-4] != "" and set(t[:-4]) <= set(".!?")

    def _clear(self) -> None:
        self.slot: dict[int, int] = {}  # by 64-bit content hash
        self.flat = np.zeros(1 << 16, np.uint32)  # ids of all chunks, one after the other
        self.ends = np.zeros(1 << 14, np.int64)  # where each chunk's ids end
        self.used = 0

    def _add(self, keys: list[int], ids: np.ndarray, counts: np.ndarray) -> None:
        k = len(self.slot)
        self.flat = _grown(self.flat, self.used + len(ids))
        self.ends = _grown(self.ends, k + len(keys))
        self.flat[self.used:self.used + len(ids)] = ids
        self.ends[k:k + len(keys)] = self.used + np.cumsum(counts)
        self.used += len(ids)
        self.slot.update(zip(keys, range(k, k + len(keys))))

    def _learn(self, new: list[tuple[bytes, int]]) -> None:
        """Encodes chunks that are new, each with its key."""
        words, others = [], []
        for c in new:
            (words if c[0].isalpha() or (not c[0].isascii() and c[0].decode().isalpha()) else others).append(c)
        # a line of words: each word ends at an id that closes a word
        for at in range(0, len(words), 4000):
            part = words[at:at + 4000]
            line = b" ".join([c for c, _ in part]).decode()
            ids = np.array(self.tok.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.word_end[ids]) + 1
            if len(ends) == len(part):
                self._add([k for _, k in part], ids, np.diff(ends, prepend=0))
            else:  # some letter of these is more than one piece
                others += part
        for at in range(0, len(others), 4000):
            part = others[at:at + 4000]
            got = [e.ids for e in self.tok.encode_batch_fast([c.decode() for c, _ in part],
                                                             add_special_tokens=False)]
            n = np.fromiter(map(len, got), np.int64, len(got))
            self._add([k for _, k in part], np.fromiter(chain.from_iterable(got), np.uint32, int(n.sum())), n)

    def _chunks(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes that the chunks of some texts are spans of, the chunks'
        starts and ends, and the number of them in each text."""
        solid = NON_SPACE[data]
        row = np.zeros(len(data) + 1, dtype=bool)
        row[offs] = True
        cut = row[:-1].copy()
        if b"<|" not in data.tobytes():
            kind = _KIND[data]
            # the second byte of a Latin-1 letter
            latin = np.append(False, data[:-1] == 0xC3) & (data != 0x97) & (data != 0xB7)
            left = np.append(0, np.where(latin, _LETTER, kind)[:-1])
            cut |= (kind == _SIGN) & ((left == _LETTER) | (left == _DIGIT))
            cut |= (kind == _DIGIT) & (left != 0) & (left != _OTHER)
            cut |= (kind == _LETTER) & (left == _DIGIT)
            cut |= (kind == _LETTER) & (left == _SIGN) & (np.append(0, data[:-1]) != 0x27)
            data = np.where(np.append(data[1:], 0) < 0x80, LOWER[data], data)
        begin = solid & (~np.append(False, solid[:-1]) | cut)
        last = solid & np.append(~solid[1:] | begin[1:], True)
        first = np.flatnonzero(begin)
        return data, first, np.flatnonzero(last) + 1, np.diff(np.searchsorted(first, offs))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of them in each text."""
        data, offs = flat_text(texts)
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        data, starts, ends, per_text = self._chunks(data, offs)
        if len(self.slot) > self.limit:
            self._clear()
        keys, at, which = np.unique(span_hasher(data)(starts, ends), return_index=True, return_inverse=True)
        slots = np.fromiter((self.slot.get(k, -1) for k in keys.tolist()), np.int64, len(keys))
        new = np.flatnonzero(slots < 0)
        if len(new):
            raw, k = data.tobytes(), keys[new].tolist()
            self._learn([(raw[a:b], k) for a, b, k in zip(starts[at[new]].tolist(), ends[at[new]].tolist(), k)])
            slots[new] = np.fromiter(map(self.slot.__getitem__, k), np.int64, len(new))
        first = np.where(slots > 0, self.ends[slots - 1], 0)
        n = (self.ends[slots] - first)[which]
        ids = self.flat[ranges(first[which], n)]
        return ids, np.diff(np.append(0, np.cumsum(n))[np.cumsum(per_text)], prepend=0)


def best_cuts(pos: list[int], penalty: list[float], window: int) -> list[int]:
    """Indexes of the cheapest cuts among the cut points ``pos`` (ascending,
    from 0; neighbours at most ``window`` apart); the last point is a cut."""
    n = len(pos)
    best = [0.0] * n
    back = [0] * n
    queue: deque[int] = deque([0])  # key best + pos rises from left to right
    key = [0.0] * n
    at = {pos[0]: 0}
    powers = [1 << b for b in range(window.bit_length()) if window <= (2 << b) and 1 << b < window]
    for j in range(1, n):
        p = pos[j]
        low = p - window
        while pos[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        cost = key[i] + window - p
        for q in powers:  # windows without padding
            k = at.get(p - q)
            if k is not None and best[k] < cost:
                cost, i = best[k], k
        best[j] = cost = cost + penalty[j]
        back[j] = i
        at[p] = j
        key[j] = k = cost + p
        while queue and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
    cuts = []
    j = n - 1
    while j:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def _points(ids: np.ndarray, doc_end: np.ndarray, sentence_end: np.ndarray, grid: int,
            costs: tuple[float, float]) -> tuple[list[int], list[float]]:
    """Cut points of a stream and their penalties; 0 and the end are points."""
    n = len(ids)
    cost = np.full(n + 1, np.inf)
    cost[grid:n:grid] = costs[1]
    cost[1:][sentence_end[ids]] = costs[0]
    cost[doc_end] = 0
    cost[[0, n]] = 0
    pos = np.flatnonzero(np.isfinite(cost))
    return pos.tolist(), cost[pos].tolist()


def _packer(path: str, window: int, block: int, grid: int, costs: tuple[float, float], end_id: int):
    schema = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = ChunkEncoder(path)
        task = TaskContext.get()
        next_id = (task.partitionId() if task else 0) << 33
        # the open stream: ids, and for each document piece in it
        # (doc id, start in the document, length here, tokens of the document)
        open_ids: list[np.ndarray] = []
        open_docs: list[tuple] = []
        held = 0

        def flush(final: bool):
            nonlocal next_id, open_ids, open_docs, held
            ids = np.concatenate(open_ids)
            lens = np.array([d[2] for d in open_docs], dtype=np.int64)
            bounds = np.concatenate([[0], np.cumsum(lens)])
            whole = np.array([d[1] + d[2] == d[3] for d in open_docs])
            pos, penalty = _points(ids, bounds[1:][whole], enc.sentence_end, grid, costs)
            cuts = [pos[c] for c in best_cuts(pos, penalty, window)]
            if not final:  # the last windows may change as ids follow
                cuts = [c for c in cuts if c <= len(ids) - 2 * window]
            end = cuts[-1] if cuts else 0
            out = []
            if end:
                marks = np.unique(np.concatenate([[0], bounds[bounds < end], cuts]))
                a, b = marks[:-1], marks[1:]
                d = np.searchsorted(bounds, a, side="right") - 1
                lo = np.concatenate([[0], cuts])[:-1]
                seq = np.searchsorted(lo, a, side="right") - 1
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(a.tolist(), b.tolist())]
                pick = [open_docs[k] for k in d.tolist()]
                begin = np.array([p[1] for p in pick], dtype=np.int64) + a - bounds[d]
                out.append(pa.RecordBatch.from_arrays([
                    pa.array([p[0] for p in pick], pa.int64()), pa.array(begin), pa.array(b - a),
                    pa.array(crc, pa.int64()), pa.array([p[3] for p in pick], pa.int64()),
                    pa.array(next_id + seq), pa.array(a - lo[seq])], schema=schema))
                next_id += len(lo)
            k = int(np.searchsorted(bounds, end, side="right")) - 1
            rest = open_docs[k:]
            if rest:
                i, s, n, t = rest[0]
                skip = end - int(bounds[k])
                rest[0] = (i, s + skip, n - skip, t)
            open_docs, open_ids, held = rest, [ids[end:]], len(ids) - end
            return out

        for batch in batches:
            for part in text_slices(batch, "text"):
                ids, counts = enc.encode(part.column("text"))
                ends = np.cumsum(counts)
                for doc, n, e in zip(part.column("doc_id").to_pylist(), counts.tolist(), ends.tolist()):
                    whole = np.append(ids[e - n:e], np.uint32(end_id))
                    for s in range(0, n + 1, block):
                        piece = whole[s:s + block]
                        open_docs.append((doc, s, len(piece), n + 1))
                        open_ids.append(piece)
                        held += len(piece)
                        if held >= block + 2 * window:
                            yield from flush(False)
        if held:
            yield from flush(True)

    return pack


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, end_id: int = END_ID, sentence_penalty: float = SENTENCE_PENALTY,
         inside_penalty: float = INSIDE_PENALTY, grid: int = GRID, block: int = BLOCK) -> DataFrame:
    """Pieces of packed documents: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset (see the module)."""
    if not 0 < grid <= window or block < 4 * window:
        raise ValueError("need 0 < grid <= window and block >= 4 * window")
    f = _packer(tokenizer_path, window, block, grid, (sentence_penalty, inside_penalty), end_id)
    d = docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")
    return docs.select(*d).mapInArrow(f, PIECES)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` as sequences of at most 2048 ids."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
