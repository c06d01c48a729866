"""Importance resampling against a plain-Python version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from curation.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


def buckets_of(t, longest, n):
    w = WORD.findall(lowered(t))
    runs = [" ".join(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]
    return [zlib.crc32(r.encode()) % n for r in runs], len(w)


def brute(rows, target, longest=1, n=10_000, share=10, least=20, seed=2024):
    of = [buckets_of(t, longest, n) for _, t in rows]
    raw = Counter(b for bs, _ in of for b in bs)
    aim = Counter(b for t in target for b in buckets_of(t, longest, n)[0])
    s_all, t_all = sum(raw.values()), sum(aim.values())

    def gain(b):
        return math.floor(1000 * math.log((aim[b] + 1.0) * (s_all + n) / ((raw[b] + 1.0) * (t_all + n))))
    out = []
    for (i, _), (bs, words) in zip(rows, of):
        weight = sum(map(gain, bs)) // max(1, len(bs))
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(bs), weight, weight + noise, None, words])
    fit = sorted((r for r in out if r[5] >= least),
                 key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    for k, r in enumerate(fit[:share * len(fit) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def texts(seed, n):
    rnd = random.Random(seed)
    vocab = ["Alpha", "beta", "naïve", "42", "don't", "x" * 70, "É", "中文", "a\x00b", "the", "of"] + [f"w{i}" for i in range(200)]
    out = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 90))) for _ in range(n)]
    return out + [None, "", " .\n", out[3], "the " * 70_000, "q" * 200_000, " ".join(out)]


def test_resample(spark):
    rows = list(enumerate(texts(1, 400)))
    rows += [(None, "alpha beta " * 15)] * 3 + [rows[5]] * 4 + [(7, "of the " * 20)]
    target = ["w1 w2 w3 the Alpha " * 30, None, "", "w7 naïve"]
    df = spark.createDataFrame([(i, t, 1, 2, "own") for i, t in rows],
                               "doc_id long, text string, rank int, score int, n_words string").repartition(7)
    aim = spark.createDataFrame([(t, 1) for t in target], "text string, rank int")
    assert got(resample.resample(df, aim)) == brute(rows, target)
    assert got(resample.resample(df, aim, longest_run=3, buckets=97, share=37, min_words=0, seed=5)) == \
        brute(rows, target, 3, 97, 37, 0, 5)
    assert got(resample.resample(df, aim.limit(0))) == brute(rows, [])
    assert resample.resample(df.limit(0), aim).count() == 0
    assert got(resample.resample(df, aim, share=0)) == brute(rows, target, share=0)


def test_every_partition_is_numbered_on(spark):
    rows = [(i, "same words here and there " * 5) for i in range(900)] + [(1, "same words here and there " * 5)] * 600
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    out = got(resample.resample(df, df, share=90))
    assert out == brute(rows, [t for _, t in rows], share=90)
    assert sorted(r[4] for r in out if r[4]) == list(range(1, 1351))


def test_planes_sum_exactly():
    rnd = np.random.default_rng(3)
    gain = rnd.integers(-70_000, 70_000, 10_000)
    planes = resample.GainPlanes(gain)
    row = np.sort(rnd.integers(0, 700, 40_000))
    bucket = np.where(rnd.random(40_000) < 0.3, 17, rnd.integers(0, 10_000, 40_000))
    want = np.bincount(row, weights=gain[bucket], minlength=800).astype(np.int64)
    assert (planes.sums(row, bucket, 800) == want).all()
    assert (resample.GainPlanes(np.zeros(10, np.int64)).sums(row, bucket % 10, 800) == 0).all()


def test_crc_of_spans():
    text = ["a", "bc" * 40, "", "é中", "z" * 47, "z" * 48, "z" * 49]
    data = np.frombuffer("".join(text).encode(), np.uint8)
    ends = np.cumsum([len(t.encode()) for t in text])
    starts = np.append(0, ends[:-1])
    assert resample.crc32_spans(data, starts, ends).tolist() == [zlib.crc32(t.encode()) for t in text]
    assert len(resample.features(pa.array([], pa.string()), 2, 10)[0]) == 0


def test_score_of_an_id(spark):
    r = spark.range(3).select(F.lit(0).alias("w"), "id").select(resample.noisy_score("w", "id")).collect()
    assert [x[0] for x in r] == [x[3] - x[2] for x in brute([(i, "") for i in range(3)], [])]
