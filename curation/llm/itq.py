"""Operator 9: embedding near-duplicates by iterative quantisation.

A rotation is learned on a bounded sample so that the signs of the rotated
vectors lose as little as possible (Gong and Lazebnik, 2011); ``ROTATIONS``
of them, from different starts, give ``ROTATIONS * dim`` bits.  The code is
cut into substrings of ``BITS`` bits, one Hamming table each.  A vector lies
in the bucket of each substring, and also probes the buckets in which its
least certain bits are flipped.  All that meet in a bucket are reranked by
the cosine of the original vectors in double precision; links are those of
at least the threshold.

How many of the pairs at the threshold meet is measured on the sample before
the search: its own borderline pairs, and partners made at exactly the
threshold towards other vectors and in random directions.  Where fewer than
``RECALL`` meet (a strong common mean, few dimensions), the cheapest of wider
searches that reach it is taken: fewer bits, more probes, more rotations; if
none does, all pairs of a label are compared.

Equal vectors of a label are one vector with a number of copies, so copies
are never compared with each other; links count them back in.

A pair that meets in several tables or buckets counts in the first alone:
that can be told from the two vectors' keys, without gathering pairs.  A
shard reports for each vector its number of links, and the links as stars
(each vector with the smallest of its local group); sums and ``components``
join the shards.

Scale: vectors are dealt by (label, table, substring) to shards of bounded
size; a bucket of more than ``shard_rows`` is split into blocks, each pair of
blocks a shard of its own, so a third of all rows in one bucket is spread
over many tasks.  Pairs never leave a shard.  ``BITS`` should grow with the
logarithm of the rows of a label (12 for up to some millions).

Defined results: vectors that are null, zero, of null label, or with null or
non-finite components link with nothing; vectors of different length do not
link; rows of one id are one vector (the smallest of its rows) and each gets
a row; rows with a null id have no links, a null component and are kept;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, ranges, table
from .components import components
from .simhash import smallest_linked

THRESHOLD = 0.93
#: Vectors that the rotations are learned on, at most.
SAMPLE = 8192
ROTATIONS = 2
BITS = 12
#: Buckets that a vector visits in each table: its own and those of its
#: ``PROBES - 1`` least certain bits.
PROBES = 2
#: Share of the pairs at the threshold that must meet, on the sample.
RECALL = 0.99
#: Wider searches: rotations, bits and probes (at most one for each bit).
WIDER = [(r, b, p) for r in (2, 4, 8) for b in (12, 10, 8, 6, 4, 3) for p in (2, 4, 13)]
#: What a row in a bucket costs, in compared pairs.
ROW_COST = 50
SHARD_ROWS = 8192
ITERATIONS = 30


def learn_rotation(x: np.ndarray, seed: int, iterations: int = ITERATIONS) -> np.ndarray:
    """An orthogonal matrix R for centred rows x that makes signs of x R a
    good stand-in for x R."""
    r = np.linalg.qr(np.random.default_rng(seed).normal(size=(x.shape[1],) * 2))[0]
    for _ in range(iterations):
        signs = np.where(x @ r > 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(x.T @ signs)
        r = u @ v
    return r


def learn(sample: np.ndarray, rotations: int = ROTATIONS) -> tuple[np.ndarray, np.ndarray]:
    """The mean of the unit vectors and the projections, side by side."""
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    mean = x.mean(axis=0)
    axes = np.linalg.eigh((x - mean).T @ (x - mean))[1]
    y = (x - mean) @ axes
    return mean, np.concatenate([axes @ learn_rotation(y, s) for s in range(rotations)], axis=1)


def bucket_keys(x: np.ndarray, mean: np.ndarray, projection: np.ndarray, bits: int, probes: int) -> np.ndarray:
    """keys[row, table, probe]: the substrings that each row visits; probe 0
    is its own.  Without bits there is one bucket."""
    if not bits:
        return np.zeros((len(x), 1, 1), np.int32)
    m = (x / np.linalg.norm(x, axis=1, keepdims=True) - mean) @ projection
    bits = min(bits, m.shape[1])
    tables = m.shape[1] // bits
    m = m[:, :tables * bits].reshape(len(x), tables, bits)
    own = ((m > 0) << np.arange(bits)).sum(axis=2)
    out = [own]
    weak = np.argsort(np.abs(m), axis=2, kind="stable")
    for k in range(min(probes - 1, bits)):
        out.append(own ^ (1 << weak[:, :, k]))
    return np.stack(out, axis=2).astype(np.int32)


def _meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the rows of the keys a and b, side by side, meet in a table."""
    return ((a == b[:, :, :1]) | (b == a[:, :, :1])).any(axis=(1, 2))


def borderline(x: np.ndarray, threshold: float, n: int = 2000, seed: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs at the threshold: towards other rows of x, in random directions,
    and those of x itself within 0.03 above it (if there are enough)."""
    rnd = np.random.default_rng(seed)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    a = u[rnd.integers(0, len(u), n)]
    out = []
    for way in (u[rnd.integers(0, len(u), n)] - a, rnd.normal(size=a.shape)):
        way = way - (way * a).sum(axis=1, keepdims=True) * a
        size = np.linalg.norm(way, axis=1)
        some = size > 1e-9
        far = np.sqrt(max(0.0, 1 - threshold * threshold))
        out.append((a[some], threshold * a[some] + far * way[some] / size[some, None]))
    part = u[:4096]
    i, j = np.nonzero(np.triu(np.abs((part @ part.T).astype(np.float32) - threshold - 0.015) <= 0.015, 1))
    if len(i) > n:
        pick = rnd.choice(len(i), n, replace=False)
        i, j = i[pick], j[pick]
    out.append((part[i], part[j]))
    return [p for p in out if len(p[0]) >= 100]


def plan(x: np.ndarray, rows: int, threshold: float, rotations: int, bits: int, probes: int):
    """The mean, projection, bits and probes of a search among so many rows
    like x in which the pairs at the threshold meet."""
    pairs = borderline(x, threshold)
    learned = {}

    def tried(r: int, b: int, p: int):
        if r not in learned:
            learned[r] = learn(x, r)
        model = (*learned[r], b, p)
        return model, min([_meet(bucket_keys(u, *model), bucket_keys(v, *model)).mean() for u, v in pairs], default=1.0)

    def cost(model) -> float:
        keys = bucket_keys(x[:2048], *model)
        n, tables, visits = keys.shape
        met = sum((np.bincount(keys[:, t, 0], minlength=1 << model[2])[keys[:, t]]).sum() for t in range(tables))
        return ROW_COST * tables * visits + rows * met / n / n

    model, recall = tried(rotations, bits, probes)
    if recall >= RECALL:
        return model
    best, least = (*learned[rotations], 0, 1), float(rows)  # all pairs
    for r, b, p in WIDER:
        model, recall = tried(r, b, p)
        if recall >= RECALL and (now := cost(model)) < least:
            best, least = model, now
    return best


def _deal(models: dict):
    """For every vector a row for each bucket that it visits."""

    def run(frames):
        for f in frames:
            for dim, g in f.groupby("dim", sort=False):
                for at in range(0, len(g), 2048):
                    p = g.iloc[at:at + 2048]
                    x = np.stack(p["vec"].to_list()).astype(np.float64)
                    keys = bucket_keys(x, *models[dim])
                    n, t, k = keys.shape
                    row = np.repeat(np.arange(n), t * k)
                    yield pd.DataFrame({
                        "id": p["id"].to_numpy()[row], "label": p["label"].to_numpy()[row], "dim": dim,
                        "tab": np.tile(np.repeat(np.arange(t), k), n).astype(np.int32),
                        "value": keys.reshape(-1), "home": np.tile(np.arange(k) == 0, n * t),
                        "n": p["n"].to_numpy()[row], "vec": p["vec"].to_numpy()[row]})

    return run


def _met_before(keys: np.ndarray, tab: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the pairs (a, b) meet in a table before ``tab``."""
    out = np.zeros(len(a), bool)
    for t in range(keys.shape[1]):
        now = (keys[a, t] == keys[b, t, :1]).any(axis=1) | (keys[b, t] == keys[a, t, :1]).any(axis=1)
        out |= now & (t < tab)
    return out


def _rerank(models: dict, threshold: float, step: int = 1 << 16):
    """The links inside a shard: for each vector its number of them (kind 0)
    and the smallest vector of its local group (kind 1)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        dim = int(rows["dim"].iloc[0])
        ids, first, who = np.unique(rows["id"].to_numpy(np.int64), return_index=True, return_inverse=True)
        x = np.stack(rows["vec"].iloc[first].to_list()).astype(np.float64)
        keys = bucket_keys(x, *models[dim])
        norm = np.sqrt((x * x).sum(axis=1))
        copies = rows["n"].to_numpy(np.int64)[first]
        # rows of one bucket stand together; every home row meets the probe
        # side of its bucket
        bucket = np.unique(rows[["label", "tab", "value"]].to_numpy(np.int64), axis=0, return_inverse=True)[1].ravel()
        left = np.flatnonzero(rows["home"].to_numpy() & rows["in_left"].to_numpy())
        right = np.flatnonzero(rows["in_right"].to_numpy())
        right = right[np.argsort(bucket[right], kind="stable")]
        lo = np.searchsorted(bucket[right], bucket[left])
        size = np.searchsorted(bucket[right], bucket[left], side="right") - lo
        tab = rows["tab"].to_numpy()
        home = rows["home"].to_numpy()
        links = np.zeros(len(ids), np.int64)
        label = np.arange(len(ids))
        at = 0
        ends = np.cumsum(size)
        while at < len(left):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + step, side="right")))
            l = np.repeat(left[at:to], size[at:to])
            r = right[ranges(lo[at:to], size[at:to])]
            at = to
            a, b = who[l], who[r]
            # two home rows meet both ways round: one is enough, also between
            # the two sides of a split bucket
            ok = (a != b) & (~home[r] | (ids[a] < ids[b]))
            l, r, a, b = l[ok], r[ok], a[ok], b[ok]
            for s in range(0, len(a), 1 << 15):
                z = slice(s, s + (1 << 15))
                p, q = a[z], b[z]
                cosine = np.einsum("ij,ij->i", x[p], x[q]) / (norm[p] * norm[q])
                near = cosine >= threshold
                p, q, t = p[near], q[near], tab[l[z]][near]
                # the probe's own bucket may hold the pair as well: the one
                # of the smaller key counts
                own = keys[p, t, 0]
                back = (keys[p, t] == keys[q, t, :1]).any(axis=1) & (own > keys[q, t, 0])
                new = ~back & ~_met_before(keys, t, p, q)
                p, q = p[new], q[new]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                label = smallest_linked(len(ids), label[p], label[q])[label]
        some, far = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(ids)))
        return pd.DataFrame({"kind": np.repeat([0, 1], [len(some), len(far)]).astype(np.int32),
                             "id": np.append(ids[some], ids[far]),
                             "n": np.append(links[some], ids[label[far]])})

    return run


def _sound(rows: DataFrame) -> DataFrame:
    """One row (id, label, dim, vec) for every vector that may link."""
    x = F.col("vec")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where("id is not null and label is not null and vec is not null")
    return (rows.where(fine & F.exists(x, lambda v: v != 0)).groupBy("id")
            .agg(F.min(F.struct("label", "vec")).alias("m")).select("id", "m.label", F.size("m.vec").alias("dim"), "m.vec"))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 threshold: float = THRESHOLD, sample: int = SAMPLE, rotations: int = ROTATIONS, bits: int = BITS,
                 probes: int = PROBES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """For every row: id, n_links, component_id, kept."""
    kind = vectors.schema[vector_col].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    raw = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                         F.col(vector_col).cast(kind).alias("vec"))
    # a number of the label is enough to keep labels apart in the shards
    rows = checkpoint(_sound(raw).withColumn("label", F.xxhash64("label"))
                      .withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64("vec", F.lit(1))}))
    # equal vectors of a label are one, with the number of its copies
    same = ["label", "dim", "h1", "h2"]
    classes = checkpoint(rows.groupBy(*same).agg(F.min("id").alias("rep"), F.count("*").alias("n")))
    reps = checkpoint(rows.join(classes.select(F.col("rep").alias("id"), "n"), "id").select("id", "label", "dim", "vec", "n"))
    models = {}
    for dim, n in reps.groupBy("dim").count().collect():  # one model for each length of vectors
        if n > 1:
            part = (reps.where(F.col("dim") == dim).orderBy(F.xxhash64("id"), "id").limit(sample)
                    .select("label", "vec").collect())
            models[dim] = plan(np.array([r["vec"] for r in part], dtype=np.float64), n // len({r["label"] for r in part}),
                               threshold, rotations, bits, probes)
    none = F.lit(None).cast("long")
    out = raw.select("id").join(rows.select("id", *same).join(classes, same).select("id", "rep", "n"), "id", "left")
    if models:
        dealt = reps.where(F.col("dim").isin(list(models))).mapInPandas(
            _deal(models), "id long, label long, dim int, tab int, value int, home boolean, n long, vec " + kind)
        found = checkpoint(_shards(dealt, shard_rows).groupBy("shard").applyInPandas(
            _rerank(models, threshold), "kind int, id long, n long"))
        links = found.where("kind = 0").groupBy(F.col("id").alias("rep")).agg(F.sum("n").alias("links"))
        groups = components(found.where("kind = 1").select(F.col("id").alias("a"), F.col("n").alias("b")))
        groups = groups.select(F.col("node").alias("rep"), F.col("component").alias("component_id"))
        out = out.join(links, "rep", "left").join(groups, "rep", "left")
    else:
        out = out.withColumns({"links": none, "component_id": none})
    out = out.select("id", (F.coalesce("links", F.lit(0)) + F.coalesce("n", F.lit(1)) - 1).alias("n_links"),
                     F.coalesce("component_id", "rep", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))


def _shards(dealt: DataFrame, shard_rows: int) -> DataFrame:
    """The rows of each shard.  Small buckets share shards; a large one is cut
    into blocks, and each ordered pair of its blocks is a shard."""
    key = ["label", "dim", "tab", "value"]
    size = checkpoint(dealt.groupBy(*key).agg(F.count("*").alias("n"), F.max(F.col("home").cast("int")).alias("own"))
                      .where("n > 1 and own = 1").select(*key, F.col("n").alias("size")))
    total = size.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // shard_rows))
    blocks = F.ceil(F.col("size") / shard_rows).cast("int")
    cut = (dealt.join(size, key).withColumn("blocks", blocks)
           .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    sides = F.when(F.col("blocks") == 1, F.array(F.struct(F.lit(True).alias("in_left"), F.lit(True).alias("in_right")))) \
        .when(F.col("block") == F.col("other"), F.array(F.struct(F.lit(True).alias("in_left"), F.lit(True).alias("in_right")))) \
        .otherwise(F.array(F.struct(F.lit(True).alias("in_left"), F.lit(False).alias("in_right")),
                           F.struct(F.lit(False).alias("in_left"), F.lit(True).alias("in_right"))))
    cut = cut.withColumn("side", F.explode(sides)).select("*", "side.*")
    x = F.when(F.col("in_left"), F.col("block")).otherwise(F.col("other"))
    y = F.when(F.col("in_left"), F.col("other")).otherwise(F.col("block"))
    shard = F.when(F.col("blocks") == 1, F.concat_ws("/", "dim", F.pmod(F.xxhash64("label", "tab", "value"), F.lit(shards)))) \
        .otherwise(F.concat_ws("/", F.lit("split"), *key, x, y))
    return cut.select(shard.alias("shard"), "id", "label", "dim", "tab", "value", "home", "n", "vec", "in_left", "in_right")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``embeddings`` of equal labels, cosine 0.93 or more."""
    out = near_vectors(table(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")
