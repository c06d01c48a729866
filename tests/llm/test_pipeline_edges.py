"""Every pipeline stage on awkward tables: nulls, empty and long texts, copies,
repeated rows, extra columns with clashing names, empty tables."""

import random

import public_tokenizers as public
from tokenizers import Tokenizer

import corpus_pipeline
from curation.llm.simhash import one_of_each

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "score string, evidence long, id string, fp long, component_id string, spans int, _base int")


def word(i):
    return "".join(chr(97 + i // 26 ** k % 26) for k in range(3)) + "o"


def rows():
    rnd = random.Random(12)
    vocab = [word(i) for i in range(500)]
    out = []
    for i in range(400):
        w = [rnd.choice(vocab) for _ in range(40)]
        if i % 4 == 0:
            w[5:5] = [rnd.choice(["vilestword", "nastything", "rottenegg"]) + rnd.choice(["", "s", "ish", "ly"])]
        out.append((i, " ".join(w)))
    out[9] = (9, out[9][1] + " bob@mail.org")
    out += [(400 + i, out[i][1]) for i in (1, 2, 3)]
    out += [(410, None), (411, ""), (412, " \n"), (413, " ".join(rnd.choice(vocab) for _ in range(60_000)))]
    out += [(None, " ".join(rnd.choice(vocab) for _ in range(30))), out[5]]
    return out


def tables(spark, path, docs, labels, items):
    pad = (None,) * 10
    spark.createDataFrame([(*d, *pad) for d in docs], DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string, doc_id string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_every_stage(spark, tmp_path):
    docs = rows()
    leak = " ".join(docs[7][1].split()[10:24]).upper()
    sf = tables(spark, tmp_path, docs, [(i, 1, int(i % 4 == 0), None) for i in range(400)] + [(None, 1, 1, "x"), (3, 0, None, None)],
                [(1, leak, "a"), (2, None, "b"), (None, "", "c")])
    left = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    ids, want = [], sorted(str(i) for i, _ in docs)

    def run(name, frame):
        out = stages[name](spark, frame, sf)
        assert out.columns == frame.columns
        ids[:] = sorted(str(r.doc_id) for r in out.select("doc_id").collect())
        return out
    left = run("toxicity", left)
    want = sorted(str(i) for i, _ in docs if i is None or i >= 400 or i % 4)
    assert ids == want
    left = run("simhash", left)
    want = sorted({i for i in want if i not in ("401", "402", "403", "411", "412")})
    assert ids == want
    left = run("decontamination", left)
    want = [i for i in want if i != "7"]
    assert ids == want
    left = run("pii", left)
    assert ids == want
    text = {r.doc_id: r.text for r in left.collect()}
    assert text[9].endswith(" [EMAIL]") and text[410] is None
    assert all(text[i] == t for i, t in docs if i in text and i != 9)
    tok = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    got = {}
    for r in corpus_pipeline.run(spark, sf).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == {i: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in text.items()}


def test_empty_tables(spark, tmp_path):
    sf = tables(spark, tmp_path / "none", [], [], [])
    assert corpus_pipeline.run(spark, sf).count() == 0
    sf = tables(spark, tmp_path / "docs", [(1, "some words"), (2, None), (None, "")], [], [])
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()} == {1, 2, None}


def test_one_of_each_sorts_no_text(spark):
    """Rows of ids that come once stream past the kept ids; only repeated
    rows are sorted, to find the smallest."""
    rnd = random.Random(4)
    vocab = [word(i) for i in range(300)]
    once = [(i, " ".join(rnd.choice(vocab) for _ in range(30)), "b") for i in range(60)]
    again = [(i, once[i][1], "a") for i in (7, 8)] + [(8, "", "c"), (None, "", "a"), (None, "", "a")] \
        + [(99, once[3][1], "d"), (99, once[4][1], "d")]
    for data, plain in ((once, True), (once + again, False)):
        out = one_of_each(spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(3))
        want = sorted(min(r for r in data if r[0] == i) for i in range(60)) + [r for r in data if r[0] is None]
        assert sorted(map(tuple, out.collect()), key=lambda r: (r[0] is None, r)) == want
        final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert ("Sort" in final) != plain
