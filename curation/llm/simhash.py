"""Operator 6: near-duplicates by SimHash fingerprints in BK-trees.

A text's words (A-Z lower-cased) give shingles of ``shingle`` words; bit j of
the 64-bit fingerprint is set if over half of the shingles' XXH64 hashes have
it.  Fingerprints that differ in at most ``radius`` bits link.

Search: fingerprints are cut into ``radius + 1`` bands of bits.  Two that
link agree on one band at least, so fingerprints are dealt to shards by each
band's value, and every linked pair meets in a shard.  A shard's BK-tree
(children keyed by their integer Hamming distance to the parent) is built
level by level, and all probes walk it at once along the edges whose key lies
within the radius of the probe's distance.  A shard reports the links inside
it as stars (each node with the smallest of its local group), never as all
pairs; ``components`` joins the stars.

Scale: equal fingerprints collapse before anything else, in a grouped
minimum.  The number of shards follows the number of fingerprints, so a tree
has a bounded size and only its own probes are sent to it.  A band value
shared by more than ``shard_rows`` fingerprints is split into blocks, and
each pair of its blocks is a shard of its own: exact, in bounded memory.
Nothing grows in the driver; trees are not broadcast to all tasks, since each
probe needs only the ``radius + 1`` shards of its own bands.

Defined results: null and empty texts have the fingerprint zero and link like
any other; a text of fewer words than a shingle has one shingle, the whole
sequence; repeated rows get a row each; rows with a null id get a row and
join their fingerprint's group, but name no group (a group of such rows alone
has a null component); other columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, same_bits, table, text_slices
from .components import components

SHINGLE = 3
RADIUS = 2
SHARD_ROWS = 8192
SEED = 42
_ASCII_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))


def _fingerprints(texts: list[str | None], shingle: int) -> np.ndarray:
    """The fingerprints of some texts."""
    from xxhash import xxh64_intdigest as xxh

    hashes: list[int] = []
    counts = []
    for t in texts:
        # bytes.split() splits at the ASCII white space \\x09-\\x0D and \\x20
        w = (t or "").encode().translate(_ASCII_LOWER).split()
        line = b" ".join(w)
        if len(w) <= shingle:
            counts.append(1 if w else 0)
            if w:
                hashes.append(xxh(line, SEED))
            continue
        ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
        starts = np.append(0, ends[:-1] + 1)
        hashes += [xxh(line[a:b], SEED) for a, b in zip(starts[:len(w) - shingle + 1].tolist(),
                                                        ends[shingle - 1:].tolist())]
        counts.append(len(w) - shingle + 1)
    n = np.array(counts, dtype=np.int64)
    out = np.zeros(len(n), np.uint64)
    h = np.array(hashes, dtype=np.uint64)
    ends = np.cumsum(n)
    some = np.flatnonzero(n)
    step = 1 << 16
    bits = np.zeros((len(n), 64), np.int64)
    for at in range(0, len(h), step):  # bounded memory for very long texts
        part = h[at:at + step]
        first = np.searchsorted(ends, at, side="right")
        cuts = np.unique(np.clip((ends - n)[some] - at, 0, len(part)))
        cuts = cuts[cuts < len(part)]
        if not len(cuts) or cuts[0] != 0:
            cuts = np.append(0, cuts)
        rows = np.searchsorted(ends, at + cuts, side="right")
        assert rows[0] == first
        raw = np.unpackbits(part.astype(">u8").view(np.uint8)).reshape(-1, 64)
        bits[rows] += np.add.reduceat(raw, cuts, axis=0, dtype=np.int32)
    over = np.packbits(2 * bits > n[:, None], axis=1)
    out[:] = over.view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``(id, fp)`` of every row; the 64 bits of ``fp`` are kept as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                fp = _fingerprints(part.column("text").to_pylist(), shingle)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(fp.view(np.int64))],
                                                 names=["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, fp long")


class BKTree:
    """A BK-tree of distinct 64-bit points under the Hamming distance."""

    def __init__(self, points: np.ndarray):
        self.points = points
        n = len(points)
        #: child[node, d]: the child at distance d from the node (-1: none)
        self.child = np.full((n, 65), -1, np.int32)
        item = np.arange(1, n)
        node = np.zeros(max(n - 1, 0), np.int64)
        while len(item):
            d = np.bitwise_count(points[item] ^ points[node])
            edge = node * 65 + d
            first = np.unique(edge, return_index=True)[1]
            self.child.reshape(-1)[edge[first]] = item[first]
            stays = np.ones(len(item), bool)
            stays[first] = False
            node = self.child.reshape(-1)[edge[stays]].astype(np.int64)
            item = item[stays]

    def within(self, probes: np.ndarray, radius: int, step: int = 2048):
        """Yield (probe index, point index) of all pairs within the radius."""
        if not len(self.points):
            return
        for at in range(0, len(probes), step):
            q = np.arange(at, min(at + step, len(probes)))
            node = np.zeros(len(q), np.int64)
            while len(q):
                d = np.bitwise_count(probes[q] ^ self.points[node]).astype(np.int64)
                near = d <= radius
                if near.any():
                    yield q[near], node[near]
                nq, nn = [], []
                for e in range(-radius, radius + 1):
                    k = d + e
                    ok = (k > 0) & (k <= 64)
                    c = self.child[node[ok], k[ok]]
                    has = c >= 0
                    nq.append(q[ok][has])
                    nn.append(c[has].astype(np.int64))
                q, node = np.concatenate(nq), np.concatenate(nn)


def smallest_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest node of its group under the links
    ``(a, b)``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _shard_links(radius: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # one point may come by several bands
        rows = rows.sort_values("id", kind="stable").groupby("fp", sort=False).agg(
            id=("id", "first"), tree=("tree", "max"), probe=("probe", "max")).reset_index()
        rows = rows.sort_values("id", kind="stable")
        fp = rows["fp"].to_numpy(np.int64).view(np.uint64)
        ids = rows["id"].to_numpy(np.int64)
        t, p = np.flatnonzero(rows["tree"]), np.flatnonzero(rows["probe"])
        label = np.arange(len(ids))
        for a, b in BKTree(fp[t]).within(fp[p], radius):
            a, b = p[a], t[b]
            apart = a != b
            # fold the links into the groups found so far
            a, b = label[a[apart]], label[b[apart]]
            label = smallest_linked(len(ids), a, b)[label]
        far = label != np.arange(len(ids))
        return pd.DataFrame({"a": ids[far], "b": ids[label[far]]})

    return run


def link_fingerprints(points: DataFrame, radius: int = RADIUS,
                      shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links ``(a, b)`` between the ids of distinct fingerprints ``(id, fp)``
    that differ in at most ``radius`` bits, enough of them to connect every
    group.  ``points`` is read several times: pass written rows."""
    n = points.count()
    bands = radius + 1
    shards = max(1, -(-n * bands // shard_rows))
    cuts = [64 * b // bands for b in range(bands + 1)]
    parts = [F.struct(F.lit(b).alias("band"),
                      F.shiftrightunsigned("fp", cuts[b]).bitwiseAND(F.lit((1 << (cuts[b + 1] - cuts[b])) - 1))
                      .alias("value")) for b in range(bands)]
    keyed = points.select("id", "fp", F.explode(F.array(*parts)).alias("k")).select("id", "fp", "k.*")
    heavy = (keyed.groupBy("band", "value").agg(F.count("*").alias("n"))
             .where(F.col("n") > shard_rows))
    dealt = (keyed.join(heavy, ["band", "value"], "left")
             .withColumn("blocks", F.coalesce(F.ceil(F.col("n") / shard_rows), F.lit(1)).cast("int"))
             .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")))
    # block b of a split band value meets every block: shards (x, y), x <= y,
    # with block x in the tree and block y as probes
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = dealt.select("id", "fp", "band", "value", "blocks", "block", other)
    x, y = F.least("block", "other"), F.greatest("block", "other")
    shard = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("band", "value"), F.lit(shards)).cast("string")) \
        .otherwise(F.concat_ws("/", F.col("band"), F.col("value"), x, y))
    rows = pairs.select(shard.alias("shard"), "id", "fp", (F.col("block") == x).alias("tree"),
                        (F.col("block") == y).alias("probe"))
    return rows.groupBy("shard").applyInPandas(_shard_links(radius), "a long, b long")


def near_groups(prints: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(id, fp, component_id)`` for rows of ``(id, fp)``; the component is
    the smallest id that links reach.  ``prints`` is read twice."""
    points = checkpoint(prints.where("id is not null").groupBy("fp").agg(F.min("id").alias("id")))
    groups = components(link_fingerprints(points, radius, shard_rows))
    named = checkpoint(points.join(groups, F.col("id") == F.col("node"), "left")
                       .select("fp", F.coalesce("component", "id").alias("component_id")))
    return prints.join(named, "fp", "left").select("id", "fp", "component_id")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = SHINGLE, radius: int = RADIUS,
                   shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(id, fp, component_id)`` for every row."""
    return near_groups(checkpoint(fingerprints(docs, id_col, text_col, shingle)), radius, shard_rows)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                radius: int = RADIUS) -> DataFrame:
    """The document of the smallest id of every group, with its own columns.
    Rows of one id are one document, of which the smallest row stays; rows
    with a null id all stay, as no group can name them."""
    groups = simhash_groups(docs, id_col, text_col, shingle, radius)
    stay = checkpoint(groups.where("id is not null").groupBy(F.col("id").alias("_stay"))
                      .agg(F.count("*").alias("_n"), F.max(F.expr("id = component_id")).alias("_first"))
                      .where("_first").select("_stay", "_n"))
    rows = (docs.where(F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("_id"), F.struct(*docs.columns).alias("_row")))

    def of(ids: DataFrame) -> DataFrame:
        # the ids are hashed and the rows stream past them: no text is sorted
        return rows.join(ids.hint("shuffle_hash"), F.col("_id") == F.col("_stay"), "left_semi")

    # by an expression of the row: a shuffle of its own, before which Spark
    # takes the minimum of each task, and AQE may split the rows of a hot id
    repeated = (of(stay.where("_n > 1")).groupBy(F.col("_row").getField(id_col).cast("long"))
                .agg(F.min("_row").alias("_row")))
    return (of(stay.where("_n = 1")).select("_row.*").unionByName(repeated.select("_row.*"))
            .unionByName(docs.where(F.col(id_col).isNull())))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: 3-word shingles, links at 2 or fewer bits."""
    out = simhash_groups(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), same_bits(F.col("fp")).alias("fingerprint"),
                      "component_id")
