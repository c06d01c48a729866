"""The operators against brute force on small, awkward tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as public
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from curation.llm import (archive, components, decontaminate, itq, licenses, packing, pii, relative_lz, simhash,
                          token_counts, toxicity)

WORDS = "alpha beta Gamma delta é-x naïve 42 don't (so) end. Stop! ##".split()


def texts(seed, n, vocab=WORDS, longest=60):
    rnd = random.Random(seed)
    out = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, longest))) for _ in range(n)]
    out += [None, "", " \n\t ", out[0], out[1] + " tail", "\n".join(rnd.choice(vocab) for _ in range(6000))]
    return out


def docs(spark, rows, extra="length long, offset long, n_words long, n_hit long, score double, spans string"):
    """Documents with ids (one null, one repeated) and clashing columns."""
    pad = [None] * len(extra.split(", "))
    ids = list(range(len(rows)))
    data = [(i, t, *pad) for i, t in zip(ids, rows)] + [(None, "alpha beta a@b.co null id", *pad), (0, rows[0], *pad)]
    return spark.createDataFrame(data, "doc_id long, text string, " + extra).repartition(3), \
        [(d[0], d[1]) for d in data]


def groups_of(n, edges):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randint(0, 200), rnd.randint(0, 200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = groups_of(400, edges)
    assert got == {n: want[n] for e in edges for n in e if e[0] != e[1]}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_packing(spark):
    path = public.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    df, rows = docs(spark, texts(2, 30) + ["<|endoftext|> x", "word," * 4000])
    got = packing.pack(df, path, window=64, block=512, grid=8).collect()
    seqs, parts = {}, {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append(r)
        parts.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for s in seqs.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 64
    want = {}
    for i, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want.setdefault((i, len(ids)), []).append(ids)
    assert want.keys() == parts.keys()
    for key, wanted in want.items():
        assert sum(r.length for r in parts[key]) == sum(map(len, wanted))
        for r in parts[key]:
            assert any(zlib.crc32(w[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for w in wanted)
    assert packing.pack(df.limit(0), path).count() == 0


def test_best_cuts_are_the_cheapest():
    rnd = random.Random(3)
    for _ in range(200):
        pos = sorted({0, *(rnd.randint(1, 40) for _ in range(20)), 40})
        pen = [rnd.choice([0, 2, 9]) for _ in pos]
        window = max(b - a for a, b in zip(pos, pos[1:])) + rnd.randint(0, 12)

        def pad(n):
            return 0 if n * 2 >= window and n & (n - 1) == 0 else window - n
        best = [0.0]
        for j in range(1, len(pos)):
            best.append(pen[j] + min(best[i] + pad(pos[j] - pos[i]) for i in range(j) if pos[j] - pos[i] <= window))
        cuts = packing.best_cuts(pos, pen, window)
        cost = sum(pen[j] + pad(pos[j] - pos[i]) for i, j in zip([0, *cuts], cuts))
        assert cuts[-1] == len(pos) - 1 and cost == best[-1]


def test_chunk_encoder():
    enc = packing.ChunkEncoder(public.path("word_bpe_49k.json"), limit=500)
    rnd = random.Random(4)
    signs = list("abXÉé'’.,!?-<>|()09 \t\n\x0b\x1c\x85\xa0ßŁİǰJ̸̱́̌×÷ª…“—中ｱ½Σς😀\x00\x7f") + \
        ["'s", "'ll", "I'M", "<|endoftext|>", "<|ENDOFTEXT|>", "≠"]
    for _ in range(60):
        some = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 40))) for _ in range(30)]
        ids, n = enc.encode(pa.array(some))
        want = [enc.tok.encode(t, add_special_tokens=False).ids for t in some]
        assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_licenses(spark):
    s = licenses.SENTENCES
    key = re.compile("|".join(licenses.KEY_WORDS), re.I)
    assert all(key.search(x) for x in [*s.values(), *licenses.MORE_SENTENCES.values()])
    assert len({licenses.normal(x) for x in s.values()}) == len(s)
    body = ["Foo.\n" + s["apache-ref"], s["mit-title"] + "\nbar baz.\n" + s["mit-notice"] + " " + s["as-is"],
            s["mit-notice"], s["gpl3-ref"].upper() + "\n" + s["cc-by-nc"] + "\n" + s["gpl3-ref"], None, "", "license " * 9000]
    df, rows = docs(spark, body, "licenses string, sentence_ids string")
    got = {r.doc_id: r.licenses for r in licenses.scan_licenses(df).collect()}
    assert [got[i] for i in range(7)] == [["Apache-2.0"], ["MIT"], [], ["GPL-3.0-only", "CC-BY-NC-4.0"], [], [], []]
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def base_spans(t):
    pats = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for k, (kind, p) in enumerate(pats.items()):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card":
                up = sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(d[::-1]))
                if not 14 <= len(d) <= 19 or up % 10:
                    continue
            if kind == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end(), kind))
    return sorted(out)


def test_personal_data(spark):
    rnd = random.Random(6)
    signs = list("ab1290.@+-% ()é\n😀") + ["4111 1111 1111 1111", "10.0.0.255", "+1 (555) 010-9999", "x@y.zz", ".co", "@b.c"]
    body = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 60))) for _ in range(250)]
    body += [None, "", "a" * 200_000 + "@", "1" * 100_000, "a@b" + ".c" * 30_000, "a@b.c%foo@d.e", "#" * 50_000 + "1" + "#" * 50_000,
             'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" then version 2.0.', "key: 00112233445566778899aabbccddeeff"]
    df, rows = docs(spark, body, "spans string, n_email long")
    noted = pii.annotate(df.select("doc_id", "text"))
    noted = noted.cache()
    model = pii.fit(noted)
    for r in pii.spans(noted, model).select("doc_id", "text", "_base", "_spans").collect():
        want = base_spans(r.text or "")
        assert [tuple(x) for x in r._base] == want
        assert {tuple(x) for x in r._spans} >= set(want)
    masked = {r.doc_id: r.text for r in pii.mask(df).where("doc_id is not null").collect()}
    at = {t: i for i, t in rows if i is not None}
    assert masked[at["a@b.c%foo@d.e"]] == "[EMAIL][EMAIL]" and masked[at[None]] is None and masked[at[""]] == ""
    assert pii.mask(df).columns == df.columns and pii.mask(df.limit(0)).count() == 0
    noted.unpersist()


def test_personal_data_reliabilities():
    yes, no = (1, 1, 0, 0, 1, 0), (-1, 0, 0, 0, 0, -1)
    post, rates = pii.estimate({yes: 50, no: 50, (0, 1, 0, 0, 0, 0): 3})
    assert post[yes] > 0.99 and post[no] < 0.01 and rates[0][1][1] > rates[0][1][0]


def test_nearest_examples_are_exact():
    rnd = np.random.default_rng(5)
    n, m = 400, 60
    dense = rnd.random((n, m)) * (rnd.random((n, m)) < 0.1)
    dense[rnd.integers(0, n, 40)] = dense[0]
    dense = dense[(dense ** 2).sum(axis=1) > 0]
    dense /= np.sqrt((dense ** 2).sum(axis=1, keepdims=True))
    index = toxicity.BlockMaxIndex([(np.flatnonzero(r), r[r > 0]) for r in dense], m, block=16)
    for batch in (dense[::7], dense[:1], dense[:0]):
        row, term = np.nonzero(batch)
        text, best, cos = index.nearest(row, term, batch[row, term], len(batch), 9, step=2)
        for i, q in enumerate(batch):
            want = dense @ q
            got = cos[text == i]
            assert np.allclose(got, np.sort(want)[::-1][:len(got)]) and np.allclose(got, np.minimum(want[best[text == i]], 1))
            assert len(got) == min(9, (want > 0).sum())


def test_toxicity(spark):
    rnd = random.Random(7)
    fine = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(500):
        w = [rnd.choice(fine) for _ in range(40)]
        if i % 4 == 0:
            w[5:5] = [rnd.choice(["vilestword", "nastything", "rottenegg"]) + rnd.choice(["", "s", "ish", "ly"])]
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows + [(500, None), (501, ""), (None, "vilestword"), (0, rows[0][1])],
                               "doc_id long, text string")
    df = df.withColumn("score", F.lit("own")).withColumn("evidence", F.lit(1))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows] + [(9999, 1), (3, None), (None, 1)],
                                   "doc_id long, toxic int")
    state = toxicity.fit(df, labels, toxicity.third)
    used = {int(i) for i in state["ids"]}
    assert not any(zlib.crc32(str(i).encode()) % 3 == 1 for i in used)
    got = {r.doc_id: r.score for r in toxicity.score(df, state).collect()}
    assert all((got[i] >= 0.7) == (i % 4 == 0) for i, _ in rows) and got[None] >= 0.7
    assert got[500] == got[501] == state["empty"] < 0.3
    assert toxicity.reject_toxic(df, labels).columns == df.columns
    none = toxicity.fit(df, labels.limit(0), toxicity.third)
    assert {r.score for r in toxicity.score(df, none).collect()} == {0.0}
    assert toxicity.score(df.limit(0), state).count() == 0


def test_relative_lz(spark):
    rnd = random.Random(8)
    vocab = ["a", "b", "c"]
    body = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 30))) for _ in range(60)]
    body += [None, "", "a " * 3000, body[5], body[5], body[6] + "\n" + body[7]]
    df, rows = docs(spark, body, "digest string, first_id long, kept string, anchors string, id string, n_removed long")
    rows.append((3, "c c c c c c b b b a"))  # another text of an id
    df = df.unionByName(spark.createDataFrame([rows[-1]], "doc_id long, text string"), allowMissingColumns=True)
    w = 6
    first = {}
    for i, t in rows:
        x = (t or "").split()
        for k in range(len(x) - w + 1):
            if i is not None:
                first[tuple(x[k:k + w])] = min(i, first.get(tuple(x[k:k + w]), i))
    want = []
    for i, t in rows:
        x = (t or "").split()
        gone = [False] * len(x)
        for k in range(len(x) - w + 1):
            if i is not None and first[tuple(x[k:k + w])] < i:
                gone[k:k + w] = [True] * w
        kept = " ".join(v for v, g in zip(x, gone) if not g)
        want.append((i if i is not None else -1, len(x), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    out = relative_lz.deduplicate(df, window=w, seed_words=3).collect()
    assert sorted((r.id if r.id is not None else -1, r.n_words, r.n_removed, r.kept_sha256) for r in out) == sorted(want)
    by = {i: (t or "").split() for i, t in rows[:len(body)]}
    for r in out:
        for f in r.factors or []:
            if r.id not in (3, None) and f.ref != 3:
                assert by[r.id][f.start:f.start + f.length] == by[f.ref][f.ref_start:f.ref_start + f.length]
    assert relative_lz.deduplicate(df.limit(0)).count() == 0


def test_simhash(spark):
    import xxhash
    rnd = random.Random(9)
    base = [rnd.choice(WORDS) + str(rnd.randint(0, 99)) for _ in range(400)]
    body = texts(9, 10)
    for _ in range(60):  # near copies
        x = base.copy()
        for _ in range(rnd.randint(0, 2)):
            x[rnd.randrange(400)] = "Changed"
        body.append(" ".join(x))
    df, rows = docs(spark, body, "fp long, component_id long, id string")
    prints = []
    for _, t in rows:
        x = re.sub("[A-Z]", lambda m: m.group().lower(), t or "").split()
        sh = [" ".join(x[k:k + 3]) for k in range(max(1, len(x) - 2))] if x else []
        hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        prints.append(sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hs) > len(hs)))
    ids = [i for i, _ in rows]
    known = [k for k, i in enumerate(ids) if i is not None]
    by_id = sorted(known, key=lambda k: ids[k])
    edges = [(a, b) for a in range(len(by_id)) for b in range(a)
             if bin(prints[by_id[a]] ^ prints[by_id[b]]).count("1") <= 2]
    group = groups_of(len(by_id), edges)
    want = {(ids[k], prints[k], ids[by_id[group[a]]]) for a, k in enumerate(by_id)}
    for shard_rows in (8192, 8):
        out = simhash.simhash_groups(df, shard_rows=shard_rows).collect()
        assert {(r.id, r.fp % (1 << 64), r.component_id) for r in out if r.id is not None} == want
    stay = simhash.one_of_each(df)
    assert stay.columns == df.columns
    assert sorted(r.doc_id for r in stay.collect() if r.doc_id is not None) == sorted({c for _, _, c in want})
    assert simhash.simhash_groups(df.limit(0)).count() == 0


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(spark, rule):
    import tiktoken
    path = public.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("t", pat_str=public.PATTERN, mergeable_ranks=token_counts.load_ranks(path), special_tokens={})
    df, rows = docs(spark, ["a b\n\n\nc  \n d😀é\n", "x", None, "", "\n", "é\n" * 300], "section string, n_tokens long")
    want = {}
    for i, t in rows:
        t = t or ""
        lines = t.split("\n")
        lines = [x + "\n" for x in lines[:-1]] + lines[-1:]
        starts = np.cumsum([0] + [len(x.encode()) for x in lines])
        n, at = np.zeros(len(lines)), 0
        for b in enc.decode_tokens_bytes(enc.encode_ordinary(t)):
            for byte in range(at, at + len(b)):
                share = {"first": byte == at, "last": byte == at + len(b) - 1, "share": 1 / len(b)}[rule]
                n[np.searchsorted(starts, byte, side="right") - 1] += share
            at += len(b)
        want[i] = [round(x, 6) for x in n]
    got = {}
    for r in sorted(token_counts.count_tokens(df, path, public.PATTERN, rule=rule).dropDuplicates(["doc_id", "section"])
                    .collect(), key=lambda r: r.section):
        got.setdefault(r.doc_id, []).append(round(r.n_tokens, 6))
    assert got == want
    two = spark.createDataFrame([(1, "user", "hi there"), (2, None, "")], "doc_id long, role string, body string")
    f = token_counts.count_tokens(two, path, public.PATTERN, fields=["role", "body"], rule=rule).collect()
    assert sorted((r.doc_id, r.section, r.char_start, r.char_end) for r in f) == [(1, 0, 0, 5), (1, 1, 5, 13), (2, 0, 0, 1), (2, 1, 1, 1)]


def test_archive(spark, tmp_path):
    big = "é" * 600
    pages = [(1, "u1", big), (2, None, big), (3, "u\r\n3", "x" * 999), (4, "u4", "x" * 999), (5, "u5", None), (6, "u6", ""),
             (7, "WARC-Type: revisit", "\r\n\r\nWARC/1.1\r\n" * 90), (None, "n", big), (2, None, big)]
    df = spark.createDataFrame([(*p, 0) for p in pages], "page_id long, url string, html string, sha256 long")
    path = archive.write_archive(df, str(tmp_path / "a"))
    rec = {r.id: r for r in archive.read_records(spark, path).collect()}
    assert {i: (r.kind, r.refers_to) for i, r in rec.items()} == {
        1: ("revisit", 2), 2: ("response", None), 3: ("response", None), 4: ("response", None), 5: ("response", None),
        6: ("response", None), 7: ("response", None), None: ("revisit", 2)}
    assert rec[3].url == "u 3"
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    for r in archive.reconstruct(spark, path).collect():
        html = {p[0]: p[2] or "" for p in pages}[r.id].encode()
        head, body = bytes(r.record).split(b"\r\n\r\n", 1)
        size = int(re.search(rb"\r\nContent-Length: (\d+)$", head)[1])
        assert body[size:] == b"\r\n\r\n" and bytes(r.payload) == html
        assert body[:size].split(b"\r\n\r\n", 1)[1] == (html if r.kind == "response" else b"")
    archive.export_warc(spark, path, str(tmp_path / "w"))
    spark.createDataFrame([("0" * 64, bytearray(b"x"))], "sha256 string, payload binary").write.mode("append").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        archive.read_payloads(spark, path).collect()
    assert archive.read_records(spark, archive.write_archive(df.limit(0), str(tmp_path / "e"))).count() == 0


def test_embedding_dedup(spark):
    rnd = np.random.default_rng(10)
    centres = rnd.normal(size=(12, 32))
    x = np.concatenate([centres[rnd.integers(0, 12, 150)] + rnd.normal(size=(150, 32)) * s for s in (0.05, 0.2, 0.3)])
    rows = [(i, v.astype(np.float32).tolist(), int(i % 3)) for i, v in enumerate(x)]
    odd = [(900, None, 1), (901, [0.0] * 32, 1), (902, [None] + [1.0] * 31, 1), (903, [float("nan")] * 32, 1),
           (904, [float("inf")] * 32, 0), (905, rows[0][1], None), (906, [1.0, 2.0], 1), (907, [2.0, 4.0], 1),
           (None, rows[0][1], 0), rows[3]]
    df = spark.createDataFrame([(*r, 0) for r in rows + odd], "vec_id long, embedding array<float>, label int, n_links int")
    v = np.array([r[1] for r in rows], np.float32).astype(float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    lab = np.array([r[2] for r in rows])
    near = (v @ v.T >= 0.93) & (lab[:, None] == lab)
    np.fill_diagonal(near, False)
    group = groups_of(len(v), list(zip(*np.nonzero(near))))
    for shard_rows in (8192, 40):
        got = {r.id: r for r in itq.near_vectors(df, shard_rows=shard_rows).collect()}
        n = np.array([got[i].n_links for i in range(len(v))])
        assert (n <= near.sum(axis=1)).all() and n.sum() >= 0.97 * near.sum()
        same = sum(got[i].component_id == group[i] for i in range(len(v)))
        assert same >= 0.97 * len(v)
        assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(900, 906))
        assert got[906].n_links == got[907].n_links == 1 and got[907].component_id == 906 and not got[907].kept
        assert got[None].n_links == 0 and got[None].component_id is None and got[None].kept
    assert itq.near_vectors(df.limit(0)).count() == 0


def test_decontamination(spark):
    rnd = random.Random(11)
    vocab = ["a", "B", "c1", "é"]
    body = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 40))) for _ in range(60)] + [None, "", "a-" * 5000]
    items = [(k, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 9)))) for k in range(12)] + \
        [(12, None), (13, ""), (13, "A, b"), (None, "c1 c1 C1 é"), (5, "é é é é é é")]
    df, rows = docs(spark, body, "n_hit long, contaminated string, _x int")
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, n_hit int")

    def cut(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    w = 5
    want = []
    for i, t in rows:
        x, hit, found = cut(t), set(), set()
        for item, s in items:
            y = cut(s)
            n = min(w, len(y))
            for win in {tuple(y[k:k + n]) for k in range(len(y) - n + 1)} if n else ():
                for k in range(len(x) - n + 1):
                    if tuple(x[k:k + n]) == win:
                        hit |= set(range(k, k + n))
                        found |= {str(item)} if item is not None else set()
        want.append((str(i), len(x), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    for block in (decontaminate.BLOCK_BYTES, 60):
        out = decontaminate.find_contamination(df, bench, window=w, block_bytes=block).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in out) == sorted(want)
    clean = decontaminate.decontaminate(df, bench, window=w)
    assert clean.columns == df.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(x[0] for x in want if not x[2])
    assert decontaminate.decontaminate(df, bench.limit(0)).count() == df.count()
    assert decontaminate.find_contamination(df.limit(0), bench).count() == 0
    long = decontaminate.longest_matches(df, bench, least=3).collect()
    at = {str(i): cut(t) for i, t in rows}
    for r in long[:200]:
        y = [cut(s) for k, s in items if str(k) == r.item_id]
        part = at[r.doc_id][r.doc_word:r.doc_word + r.length]
        assert any(s[r.item_word:r.item_word + r.length] == part for s in y) or r.item_id is None


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    left = spark.read.parquet(f"{sf}/documents.parquet").cache()
    cols = left.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash", "decontamination", "pii", "packing"]
    state = toxicity.fit(left, spark.read.parquet(f"{sf}/labels.parquet"), toxicity.third)
    left = toxicity.score(left, state).where("score < 0.7").select(*cols)
    g = {r.id for r in simhash.simhash_groups(left).collect() if r.id == r.component_id}
    left = left.where(F.col("doc_id").isin(list(g)))
    bad = {r.doc_id for r in decontaminate.find_contamination(left, spark.read.parquet(f"{sf}/benchmark.parquet"))
           .where("contaminated").collect()}
    want = {r.doc_id: r.text for r in pii.mask(left.where(~F.col("doc_id").isin(list(bad)))).collect()}
    tok = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    got = {}
    for r in corpus_pipeline.run(spark, sf).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == {i: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in want.items()}


def test_toxicity_rare_words_and_copies(spark):
    rnd = random.Random(8)
    fine, bad = [f"w{i}" for i in range(300)], [f"{a}{b}x" for a in "bdfgk" for b in range(12)]
    # each toxic word is in no more than three of the toxic examples
    rows = []
    for i in range(400):
        w = [rnd.choice(fine) for _ in range(12)]
        if i % 4 == 0:
            w += [f"q{i}z", f"v{i}j", bad[i // 4 % 60]]
        rows.append((i, " ".join(w)))
    learned = [i for i, _ in rows if i % 4 == 0 and zlib.crc32(str(i).encode()) % 3 != 1]
    copies = [(1000 + i, rows[i][1]) for i in learned]
    df = spark.createDataFrame(rows + copies, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    state = toxicity.fit(df, labels, toxicity.third)
    assert len(state["vocab"]) > 300  # the terms of clean examples as well
    got = {r.doc_id: r for r in toxicity.score(df, state).collect()}
    for i in learned:
        first = got[1000 + i].evidence[0]
        assert got[1000 + i].score >= 0.7 and first.example == i and first.cosine > 0.999999
    assert all(got[i].score < 0.7 for i, _ in rows if i % 4 and zlib.crc32(str(i).encode()) % 3 != 1)
    kept = {r.doc_id for r in toxicity.reject_toxic(df, labels).collect()}
    assert not kept & {i for i, _ in copies}
    # many copies of one labelled text are one example, and make no lexicon of its words
    df = spark.createDataFrame([(i, "same old text") for i in range(40)] + [(100 + i, f"other {i}") for i in range(40)],
                               "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(40)],
                                   "doc_id long, toxic int")
    state = toxicity.fit(df, labels, lambda c: F.lit(False))
    assert len(state["ids"]) == 41 and state["labels"].sum() == 1


@pytest.mark.parametrize("dim, offset", [(64, 0.0), (32, 1.0), (32, 2.0), (16, 0.0), (3, 0.0)])
def test_embedding_dedup_at_the_threshold(spark, dim, offset):
    rnd = np.random.default_rng(dim)
    a = rnd.normal(size=(700, dim)) / np.sqrt(dim)
    a[:, 0] += offset  # a mean that all vectors share
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    way = rnd.normal(size=a.shape)
    way -= (way * a).sum(axis=1, keepdims=True) * a
    way /= np.linalg.norm(way, axis=1, keepdims=True)
    c = rnd.uniform(0.931, 0.95, (700, 1))
    x = np.concatenate([a, c * a + np.sqrt(1 - c * c) * way]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    v = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = v @ v.T >= 0.93
    np.fill_diagonal(near, False)
    got = {r.id: r.n_links for r in itq.near_vectors(df).collect()}
    n = np.array([got[i] for i in range(len(x))])
    assert (n <= near.sum(axis=1)).all() and n.sum() >= 0.98 * near.sum()


def test_license_gate_by_words(spark):
    body = ["All rights reserved.", "all rights\treserved", "All rights\u00a0reserved.", "All  rights - reserved"]
    df, _ = docs(spark, body, "licenses string, sentence_ids string")
    assert all(r.licenses == ["Proprietary"] for r in licenses.scan_licenses(df).where("doc_id is not null").collect())


def test_every_license_sentence_is_found(spark):
    s = licenses.SENTENCES
    df = spark.createDataFrame([(i, x) for i, x in s.items()] + [(i, f"Foo bar\r\n # {x} \nbaz") for i, x in s.items()],
                               "name string, text string")
    got = licenses.scan_licenses(df).collect()
    assert len(got) == 2 * len(s) and all(r.sentence_ids == [r.name] for r in got)
    # a part of a piece is no sentence
    df = spark.createDataFrame([("No " + s["mit-ref"],), (s["spdx-mit"] + " or so",)], "text string")
    assert all(r.sentence_ids == [] for r in licenses.scan_licenses(df).collect())


def test_wrapped_licenses(spark):
    import textwrap

    s = licenses.SENTENCES
    clauses = [s["bsd-source"], s["bsd-binary"], licenses.MORE_SENTENCES["bsd-endorse"].replace("*", "Foo Inc.")]

    def bsd(n, mark, sign="", width=74):
        parts = ["Copyright (c) 2020, Foo Inc.\nAll rights reserved.", textwrap.fill(s["bsd-grant"], width)]
        parts += [textwrap.fill(mark.format(i + 1) + c, width, subsequent_indent="   ") for i, c in enumerate(clauses[:n])]
        return "\n".join((sign + x).rstrip() for x in "\n\n".join(parts).split("\n"))

    mit = "\n\n".join(textwrap.fill(s[x], 72) for x in ("mit-title", "mit-notice", "as-is"))
    gpl = textwrap.indent(textwrap.fill(" ".join(s[x] for x in ("gpl-free", "gpl-hope", "gpl-fit")), 70), "# ")
    apache = " * " + s["apache-hdr-1"] + "\n * " + s["apache-hdr-2"] + \
        "\n * You may obtain a copy of the License at\n *\n *     http://www.apache.org/licenses/LICENSE-2.0\n"
    one_line = "\n".join([s["bsd-grant"], *clauses])
    want = [(bsd(2, "{}. "), ["BSD-2-Clause"]), (bsd(3, "{}. "), ["BSD-3-Clause"]),
            (bsd(3, "({}) ", " * "), ["BSD-3-Clause"]), (bsd(3, "* ", "// "), ["BSD-3-Clause"]),
            (mit, ["MIT"]), (mit.replace("\n", "\r\n"), ["MIT"]), (gpl, ["GPL-3.0-or-later"]), (apache, ["Apache-2.0"]),
            (one_line, ["BSD-3-Clause"])]
    m = licenses.MORE_SENTENCES
    want += [(textwrap.indent(textwrap.fill(m[i], 66), sign), [name]) for i, sign, name in (
        ("gpl2-free", " * ", "GPL-2.0-or-later"), ("lgpl-free", "# ", "LGPL-2.1-or-later"), ("agpl-free", "// ", "AGPL-3.0-or-later"),
        ("mpl-form", "/* ", "MPL-2.0"), ("isc-grant", "", "ISC"), ("unlicense", "", "Unlicense"), ("bsl-grant", "", "BSL-1.0"),
        ("epl-terms", " * ", "EPL-2.0"))]
    want += [("All rights reserved.", ["Proprietary"]),
             (s["bsd-grant"] + "\n" + clauses[0] + "\nAll rights reserved.\n" + clauses[1], ["BSD-2-Clause"]),
             ("// SPDX-License-Identifier: GPL-2.0-only", ["GPL-2.0-only"]), ("# spdx-license-identifier: BSD-3-Clause.\nx", ["BSD-3-Clause"]),
             ("/* SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only with Classpath-exception-2.0 */",
              ["MIT", "Apache-2.0", "GPL-2.0-only WITH Classpath-exception-2.0"]),
             ("SPDX-License-Identifier: MIT\n" + s["mit-ref"] + "\nAll rights reserved.", ["MIT"]), ("SPDX-License-Identifier:", [])]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(want)], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    assert [got[i].licenses for i in range(len(want))] == [w for _, w in want]
    assert got[6].sentence_ids == ["gpl-free", "gpl-hope", "gpl-fit"]
    assert got[7].sentence_ids == ["apache-hdr-1", "apache-hdr-2", "apache-hdr-3"]


@pytest.mark.parametrize("common, block", [(1.0, 16), (1.0, 2), (0.11, 16), (0.11, 2)])
def test_nearest_examples_by_postings(monkeypatch, common, block):
    rnd = np.random.default_rng(6)
    n, m = 400, 60
    dense = rnd.random((n, m)) ** 4 * (rnd.random((n, m)) < 0.1)
    dense = dense[(dense ** 2).sum(axis=1) > 0]
    dense /= np.sqrt((dense ** 2).sum(axis=1, keepdims=True))
    monkeypatch.setattr(toxicity, "COMMON", common)
    index = toxicity.BlockMaxIndex([(np.flatnonzero(r), r[r > 0]) for r in dense], m, block=block)
    row, term = np.nonzero(dense[::7])
    text, best, cos = index.nearest(row, term, dense[::7][row, term], len(dense[::7]), 9, step=1)
    for i, q in enumerate(dense[::7]):
        want = dense @ q
        got = cos[text == i]
        assert np.allclose(got, np.sort(want)[::-1][:len(got)]) and np.allclose(got, want[best[text == i]])


def test_equal_vectors_are_compared_once(spark):
    rnd = np.random.default_rng(9)
    hot = rnd.normal(size=16)
    near = hot + 0.05 * rnd.normal(size=16)
    far = rnd.normal(size=(300, 16))
    rows = [(i, [float(v) for v in hot], 1) for i in range(60_000)] + [(60_000 + i, [float(v) for v in near], 1) for i in range(3)]
    rows += [(70_000, [float(v) for v in hot], 2), (70_001, [float(v) for v in hot], 2)]
    rows += [(80_000 + i, [float(v) for v in x], 1) for i, x in enumerate(far)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.id: (r.n_links, r.component_id, r.kept) for r in itq.near_vectors(df).collect()}
    assert got[0] == (60_002, 0, True) and got[59_999] == (60_002, 0, False) and got[60_001] == (60_002, 0, False)
    assert got[70_000] == (1, 70_000, True) and got[70_001] == (1, 70_000, False)
    assert len(got) == len(rows)
