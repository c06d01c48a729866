"""Operator 4: toxicity by nearest labelled examples under TF-IDF cosine.

Terms are words (A-Z lower-cased) and their first 4, 5 and 6 bytes, so that a
stem is met again in words never seen before.  Every term of every labelled
example is indexed; a term weighs its TF-IDF (document frequencies of all
documents) times its lean: the squared phi coefficient with the toxic label
where toxic examples hold it more often, and ``FLOOR`` besides, so that no
term is without weight (with plain TF-IDF the topic of a text outvotes its
toxic words).  Terms of a text that no example holds count in its length.  A
text's nearest examples are found exactly: an inverted index keeps the largest
weight of each term in each block of examples; a batch of texts visits blocks
in falling order of their bound, and only those whose bound reaches the k-th
best.  The neighbours vote, weighted by the share of the text's squared
length that lies along the example over the share that does not, so that an
example the text copies decides; the vote is corrected for the sampled class
sizes, and pulled to the base rate when little evidence supports it.  Equal
example texts of a class are one example, so copies neither vote nor count
twice.
A text that shares no term with an example has no neighbour; its score is the
share of toxic labels among examples without terms.

Scale: two passes over the texts (document frequencies; scores), both without
a shuffle of texts.  What is broadcast and collected is bounded:
``examples`` labelled rows of each class, with all of their terms.  Document
frequencies are summed per task before they are shuffled.

Defined results: null and empty texts are texts without terms; labels that
are null, or of rows without a document, are not used; of several labels of a
document the largest holds; without any label every score is 0; rows with a
null id are scored but never learned from; ties between neighbours go to the
smaller place in the index; other columns pass unchanged; repeated rows are
scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (ALNUM, LOWER, checkpoint, flat_text, mix64, ranges, span_hasher, table, text_slices, word_spans)

#: Labelled examples of each class, at most.
EXAMPLES = 2000
#: The lean of a term that tells the classes apart in no way.
FLOOR = 1e-4
NEIGHBOURS = 15
BLOCK = 64
#: Share of the examples from which on a term is common, the relative error
#: that a sum in single precision may have, and rows summed again at a time.
COMMON, SLACK, EXACT_ROWS = 0.06, 2e-4, 1024
#: Bytes of text cut into terms, texts compared with the examples, and texts
#: whose postings are added, at a time.
TERM_BYTES, TEXTS, POSTED_TEXTS = 1 << 20, 128, 16
THRESHOLD = 0.7
PREFIXES = (4, 5, 6)


def terms(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of some texts and the text that each is in."""
    data, offs = flat_text(arr)
    data = LOWER[data]
    s, e, ptr = word_spans(data, offs, ALNUM)
    row = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    hashes = span_hasher(data)
    out, rows = [hashes(s, e)], [row]
    for p in PREFIXES:
        long = (e - s) > p
        out.append(mix64(hashes(s[long], s[long] + p) ^ np.uint64(p)))
        rows.append(row[long])
    return np.concatenate(out), np.concatenate(rows)


def counted(row: np.ndarray, term: np.ndarray):
    """(text, term, count) of each distinct term, ordered by text and term."""
    by = np.lexsort((term, row))
    term, row = term[by], row[by]
    new = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (row[1:] != row[:-1]))[:len(term)])
    return row[new], term[new], np.diff(np.append(new, len(term)))


def term_counts(arr: pa.Array, vocab: np.ndarray, others: bool = True):
    """(text, vocabulary index, count) of the vocabulary's terms in some
    texts, ordered by text, and (text, term, count) of the other terms (none
    unless ``others``); ``vocab`` is sorted.  Each distinct word is cut into
    terms and looked up once."""
    data, offs = flat_text(arr)
    data = LOWER[data]
    s, e, ptr = word_spans(data, offs, ALNUM)
    row = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    hashes = span_hasher(data)
    word, at, which = np.unique(hashes(s, e), return_index=True, return_inverse=True)
    s, e = s[at], e[at]
    parts, owner, column = [word], [np.arange(len(word))], [np.zeros(len(word), np.int64)]
    for j, p in enumerate(PREFIXES):
        long = np.flatnonzero(e - s > p)
        parts.append(mix64(hashes(s[long], s[long] + p) ^ np.uint64(p)))
        owner.append(long)
        column.append(np.full(len(long), j + 1))
    term, local = np.unique(np.concatenate(parts), return_inverse=True)
    of = np.full((len(word), 1 + len(PREFIXES)), -1, np.int32)
    of[np.concatenate(owner), np.concatenate(column)] = local
    known = np.minimum(np.searchsorted(vocab, term), max(0, len(vocab) - 1))
    hit = vocab[known] == term if len(vocab) else np.zeros(len(term), bool)
    if not others:
        of[~hit[of] | (of < 0)] = -1
    of = of[which].ravel()
    there = np.flatnonzero(of >= 0)
    pair, n = np.unique(row[there // (1 + len(PREFIXES))] * len(term) + of[there], return_counts=True)
    row, local = np.divmod(pair, max(1, len(term)))
    mine = hit[local]
    return (row[mine], known[local[mine]], n[mine]), (row[~mine], term[local[~mine]], n[~mine])


class BlockMaxIndex:
    """Exact nearest examples under the cosine of sparse unit vectors, for a
    batch of texts at a time.

    Terms of more than a share ``COMMON`` of the examples stand in a matrix,
    with the largest weight of each block of examples; the others in postings
    (most of these hold one example a block, so that each is its own largest
    weight).  A block's bound is the largest sum of postings in it plus the
    common terms' largest weights; the common terms of a block are added only
    for the texts whose bound reaches the k-th best so far.  Examples' weights
    have single precision; what is within ``SLACK`` of the k-th best is summed
    again in double precision."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK):
        """rows: for each example the term indexes and unit weights."""
        self.n, self.block = len(rows), block
        size = np.array([len(r[0]) for r in rows], dtype=np.int64)
        term = np.concatenate([r[0] for r in rows]).astype(np.int64) if rows else np.zeros(0, np.int64)
        weight = np.concatenate([r[1] for r in rows]).astype(np.float32) if rows else np.zeros(0, np.float32)
        example = np.repeat(np.arange(self.n), size)
        often = np.flatnonzero(np.bincount(term, minlength=n_terms) > COMMON * self.n)
        self.place = np.full(n_terms, -1, np.int32)
        self.place[often] = np.arange(len(often))
        at = self.place[term]
        self.common = np.zeros((self.n, len(often)), np.float32)
        self.common[example[at >= 0], at[at >= 0]] = weight[at >= 0]
        self.starts = np.arange(0, self.n, block)
        self.top = np.maximum.reduceat(self.common, self.starts, axis=0) if self.n else self.common
        term, weight, example = term[at < 0], weight[at < 0], example[at < 0]
        by = np.argsort(term, kind="stable")
        self.post_weight, self.post = weight[by], example[by].astype(np.int32)
        self.ptr = np.zeros(n_terms + 1, np.int32)
        np.cumsum(np.bincount(term, minlength=n_terms), out=self.ptr[1:])

    def nearest(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, k: int, step: int = 4):
        """(text, example, cosine) of the k examples of largest cosine above
        0 of n texts, by text and falling cosine."""
        if not self.n or not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        at = self.place[term]
        some = at < 0
        rare = np.zeros((n, self.n))
        t, w, r = term[some], weight[some], row[some]
        cut = np.searchsorted(r, np.arange(0, n + POSTED_TEXTS, POSTED_TEXTS))
        for i, (x, y) in enumerate(zip(cut[:-1], cut[1:])):  # a text has tens of thousands of postings
            first, size = self.ptr[t[x:y]].astype(np.int64), self.ptr[t[x:y] + 1] - self.ptr[t[x:y]]
            post = ranges(first, size)
            here = rare[i * POSTED_TEXTS:(i + 1) * POSTED_TEXTS]
            here += np.bincount(np.repeat((r[x:y] - i * POSTED_TEXTS) * self.n, size) + self.post[post], minlength=here.size,
                                weights=np.repeat(w[x:y], size) * self.post_weight[post]).reshape(here.shape)
        q = np.zeros((n, self.common.shape[1]), np.float32)
        q[row[~some], at[~some]] = weight[~some]
        score = rare.astype(np.float32)
        bound = (np.maximum.reduceat(score, self.starts, axis=1) + q @ self.top.T) * (1 + SLACK)
        kth = np.zeros(n, np.float32)
        todo = bound > 0
        step = min(step, len(self.starts))
        while todo.any():
            # the blocks of largest bound first
            low = -np.partition(np.where(todo, -bound, 0), step - 1, axis=1)[:, [step - 1]]
            now = todo & (bound >= low)
            for b in np.flatnonzero(now.any(axis=0)):
                texts = np.flatnonzero(now[:, b])
                here = slice(self.starts[b], self.starts[b] + self.block)
                score[texts, here] += q[texts] @ self.common[here].T
            if self.n > k:
                kth = np.partition(score, self.n - k, axis=1)[:, self.n - k] * (1 - SLACK)
            # no other block can reach the k-th best
            todo = todo & ~now & (bound >= kth[:, None])
            step = len(self.starts)
        text, best = np.nonzero((score > 0) & (score >= kth[:, None]))
        cos = rare[text, best]  # again in double precision
        query = np.zeros(q.shape)
        query[row[~some], at[~some]] = weight[~some]
        for x in range(0, len(text), EXACT_ROWS):
            z = slice(x, x + EXACT_ROWS)
            cos[z] += np.einsum("ij,ij->i", query[text[z]], self.common[best[z]], dtype=float)
        by = np.lexsort((best, -cos, text))
        text, best, cos = text[by], best[by], cos[by]
        keep = np.arange(len(text)) - np.searchsorted(text, text) < k
        return text[keep], best[keep], np.minimum(cos[keep], 1.0)


def tfidf(count: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return (1 + np.log(count)) * weight


class Model:
    """Vocabulary, term weights, examples and class weights, with the votes."""

    def __init__(self, state: dict):
        self.vocab, self.weight, self.other = state["vocab"], state["term_weight"], state["other_weight"]
        self.labels, self.ids = state["labels"], state["ids"]
        self.class_weight, self.base, self.empty = state["class_weight"], state["base"], state["empty"]
        self.k = state["neighbours"]
        rows = []
        for t, c in state["rows"]:
            w = tfidf(c, self.weight[t])
            rows.append((t, w / np.sqrt((w * w).sum())))
        self.index = BlockMaxIndex(rows, len(self.vocab))

    @staticmethod
    def of(state: dict) -> Model:
        """The model of a state, made once in a process."""
        if "model" not in state:
            state["model"] = Model(state)
            del state["rows"]  # the index holds what is in them
        return state["model"]

    def scores(self, row: np.ndarray, term: np.ndarray, count: np.ndarray, rest: np.ndarray, step: int = TEXTS):
        """The score of each text, and (text, example, cosine) of its
        neighbours; ``rest`` is the squared length of each text's terms
        outside the vocabulary."""
        w = tfidf(count, self.weight[term])
        w /= np.sqrt(np.bincount(row, weights=w * w, minlength=len(rest)) + rest)[row]
        score = np.full(len(rest), self.empty)
        cut = np.searchsorted(row, np.arange(len(rest) + 1))
        found = []
        for at in range(0, len(rest), step):
            to = min(at + step, len(rest))
            z = slice(cut[at], cut[to])
            text, best, cos = self.index.nearest(row[z] - at, term[z], w[z], to - at, self.k)
            score[at:to] = np.where(np.diff(cut[at:to + 1]) > 0, self.vote(text, best, cos, to - at), self.empty)
            found.append((text + at, best, cos))
        return score, *(np.concatenate(x) for x in zip(*found))

    def vote(self, text: np.ndarray, best: np.ndarray, cos: np.ndarray, n: int) -> np.ndarray:
        w = cos * cos / (1 - cos * cos + 1e-6) * self.class_weight[self.labels[best]]
        # as much as one neighbour of the rarer class that explains half of the text
        pull = self.class_weight[self.class_weight > 0].min() if len(self.labels) else 1.0
        toxic = np.bincount(text, weights=w * self.labels[best], minlength=n)
        return (toxic + pull * self.base) / (np.bincount(text, weights=w, minlength=n) + pull)


def _example_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                  held_out, examples: int) -> tuple[DataFrame, dict[int, int]]:
    """Labelled examples (id, y, copies, text), equal texts of a class as one,
    and the labelled rows of each class."""
    y = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
         .groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("y")))
    there = docs.select(F.col(id_col).cast("long").alias("_id")).where("_id is not null").distinct()
    y = checkpoint(y.where(~held_out("_id")).join(there, "_id", "left_semi"))
    n = dict(y.groupBy("y").count().collect())
    pick = [y.where(F.col("y") == c).orderBy(F.xxhash64("_id"), "_id").limit(examples) for c in (0, 1)]
    # 2 * examples rows of (id, label): a bounded broadcast
    rows = (docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text"))
            .join(F.broadcast(pick[0].unionByName(pick[1])), "_id")
            .groupBy("_id", "y").agg(F.min("text").alias("text"))
            .groupBy("y", "text").agg(F.min("_id").alias("_id"), F.count("*").alias("copies")))
    return checkpoint(rows), {c: n.get(c, 0) for c in (0, 1)}


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All terms of the examples, and how often each holds them."""
    for batch in batches:
        for part in text_slices(batch, "text"):
            t, row = terms(part.column("text"))
            row, t, k = counted(row, t)
            cut = np.searchsorted(row, np.arange(part.num_rows + 1))
            spans = list(zip(cut[:-1], cut[1:]))
            yield pa.RecordBatch.from_arrays([
                part.column("_id"), part.column("y"), part.column("copies"),
                pa.array([t[x:y].tobytes() for x, y in spans], pa.binary()),
                pa.array([k[x:y].astype(np.int32).tobytes() for x, y in spans], pa.binary())],
                names=["_id", "y", "copies", "t", "k"])


def _frequencies(vocab_b):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocab_b.value
        df = np.zeros(len(vocab) + 1, np.int64)  # the last: all documents
        for batch in batches:
            for part in text_slices(batch, "text", TERM_BYTES):
                df[:-1] += np.bincount(term_counts(part.column("text"), vocab, False)[0][1], minlength=len(vocab))
                df[-1] += part.num_rows
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["term", "df"])

    return run


def toxic_lean(pos: np.ndarray, neg: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """The squared phi coefficient of terms with the toxic label, 0 where
    clean examples hold a term as often or more."""
    cross = pos * (n0 - neg) - neg * (n1 - pos)
    rest = (pos + neg) * (n1 + n0 - pos - neg) * float(n1) * float(n0)
    return np.where(cross > 0, cross.astype(np.float64) ** 2 / np.maximum(1.0, rest), 0.0)


def fit(docs: DataFrame, labels: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", examples: int = EXAMPLES, neighbours: int = NEIGHBOURS) -> dict:
    """The model's state.  ``held_out(id column name)`` tells the rows never
    learned from."""
    sc = docs.sparkSession.sparkContext
    rows, n = _example_rows(docs, labels, id_col, text_col, label_col, held_out, examples)
    # at most 2 * examples rows, the distinct terms of their texts
    found = rows.mapInArrow(_vectors, "_id long, y int, copies long, t binary, k binary").orderBy("_id").collect()
    size = [sum(r["copies"] for r in found if r["y"] == c) for c in (0, 1)]
    have = [r for r in found if r["t"]]
    hashes = [np.frombuffer(r["t"], np.uint64) for r in have]
    vocab = np.unique(np.concatenate(hashes)) if have else np.zeros(0, np.uint64)
    vectors = [(np.searchsorted(vocab, t).astype(np.int32), np.frombuffer(r["k"], np.int32))
               for r, t in zip(have, hashes)]
    pos, neg = (sum((np.bincount(t, minlength=len(vocab)) for r, (t, _) in zip(have, vectors) if r["y"] == c),
                    np.zeros(len(vocab), np.int64)) for c in (1, 0))
    n1, n0 = (sum(r["y"] == c for r in found) for c in (1, 0))
    df = np.zeros(len(vocab) + 1)
    sums = (docs.select(F.col(text_col).alias("text"))
            .mapInArrow(_frequencies(sc.broadcast(vocab)), "term long, df long")
            .groupBy("term").agg(F.sum("df").alias("df")).toArrow())  # a row for each term of the examples
    df[sums["term"].to_numpy()] = sums["df"].to_numpy()
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    lean = toxic_lean(pos, neg, n1, n0) + FLOOR
    strength = idf * lean
    weight = np.array([n[c] / max(1, size[c]) for c in (0, 1)])
    # examples that share their strongest terms lie in one block
    strong = [(t[np.lexsort((t, -strength[t]))[:16]].tolist(), r["_id"]) for r, (t, _) in zip(have, vectors)]
    order = sorted(range(len(have)), key=strong.__getitem__)
    blank = [r["copies"] * weight[r["y"]] * np.array([r["y"], 1.0]) for r in found if not r["t"]]
    empty = np.sum(blank, axis=0) if blank else np.zeros(2)
    base = n[1] / max(1, n[0] + n[1])
    return {"vocab": vocab, "term_weight": strength, "labels": np.array([have[i]["y"] for i in order], dtype=np.int64),
            # as a term of one document
            "other_weight": (np.log((1 + df[-1]) / 2) + 1) * FLOOR,
            "ids": np.array([have[i]["_id"] for i in order], dtype=np.int64),
            "rows": [vectors[i] for i in order], "class_weight": weight,
            "base": base, "empty": empty[0] / empty[1] if empty[1] else base, "neighbours": neighbours}


_EVIDENCE = T.ArrayType(T.StructType([T.StructField("example", T.LongType()), T.StructField("toxic", T.IntegerType()),
                                      T.StructField("cosine", T.DoubleType())]))


def score(docs: DataFrame, state: dict, text_col: str = "text", score_col: str = "score",
          evidence_col: str = "evidence", n_evidence: int = 3) -> DataFrame:
    """``docs`` with a score (0 to 1) and the nearest examples that support it
    (own columns of those names are replaced)."""
    state_b = docs.sparkSession.sparkContext.broadcast(state)
    keep = [c for c in docs.columns if c not in (score_col, evidence_col)]
    docs = docs.select(*keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.of(state_b.value)
        kind = pa.list_(pa.struct([("example", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())]))
        for batch in batches:
            for part in text_slices(batch, text_col, TERM_BYTES):
                (row, term, count), (at, _, n) = term_counts(
                    part.column(part.schema.get_field_index(text_col)), model.vocab)
                rest = np.bincount(at, weights=tfidf(n, model.other) ** 2, minlength=part.num_rows)
                if not part.num_rows:
                    continue
                out, text, best, cos = model.scores(row, term, count, rest)
                top = np.arange(len(text)) - np.searchsorted(text, text) < n_evidence
                why = pa.StructArray.from_arrays(
                    [pa.array(model.ids[best[top]]), pa.array(model.labels[best[top]], pa.int32()), pa.array(cos[top])],
                    fields=list(kind.value_type))
                offs = np.searchsorted(text[top], np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.clip(out, 0, 1)), pa.ListArray.from_arrays(pa.array(offs), why, type=kind)],
                    names=[*keep, score_col, evidence_col])

    schema = T.StructType([*docs.schema, T.StructField(score_col, T.DoubleType()),
                           T.StructField(evidence_col, _EVIDENCE)])
    return docs.mapInArrow(run, schema)


def third(id_col: str):
    """Rows whose crc32 of the id as text leaves 1 when divided by 3; rows
    with a null id as well, as they are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with their own columns."""
    state = fit(docs, labels, third)
    marked = score(docs.select("*"), state, score_col="_toxicity", evidence_col="_toxic_evidence")
    return marked.where(F.col("_toxicity") < threshold).select(*docs.columns)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all ``documents``; the third of ``third`` is held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    state = fit(docs, table(spark, sf_dir, "labels"), third)
    return score(docs, state).select("doc_id", third("doc_id").alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")
