import random

from pyspark.sql import functions as F

from brute import page_part_faults
from curation.operators.chunk import chunk_documents, split_message
from curation.sources import notes as N


def _parts(spark, texts, profile):
    df = spark.createDataFrame(list(enumerate(texts)), "doc int, text string")
    out = chunk_documents(df, "text", ["doc"], profile).collect()
    by = {}
    for r in sorted(out, key=lambda r: (r.doc, r.part_no)):
        by.setdefault(r.doc, []).append(r.part)
    return [by.get(i, []) for i in range(len(texts))]


def test_page_profile_boundaries(spark):
    a = "x" * 399 + "\n\n" + "y" * 2000          # separator starts at 399 -> too early, hard cut
    b = "x" * 400 + "\n\n" + "y" * 2000          # separator at 400 -> cut there
    c = "x" * 1799 + "\n\n" + "y" * 100          # separator straddles the window -> hard cut
    texts = [a, b, c, "", "  short  "]
    assert _parts(spark, texts, "page") == [
        ["x" * 399 + "\n\n" + "y" * 1399, "y" * 601], ["x" * 400, "y" * 1800, "y" * 200],
        ["x" * 1799, "y" * 100], [""], ["short"]]


def test_page_profile_random(spark):
    rnd = random.Random(11)
    texts = ["".join(rnd.choice(["word ", "\n\n", "\n", "é", " "]) for _ in range(rnd.randint(0, 2500)))
             for _ in range(30)]
    for t, parts in zip(texts, _parts(spark, texts, "page")):
        assert not page_part_faults(t, parts)


def test_message_profile_rejoins_and_bounds(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(["abc ", "\n", "😀", "z"]) for _ in range(rnd.randint(0, 5000))) for _ in range(20)]
    texts += ["", "a" * 4001, "\n" * 9000]
    got = _parts(spark, texts, "message")
    for t, parts in zip(texts, got):
        assert "".join(parts) == t                      # nothing stripped, nothing lost
        assert all(len(p.encode("utf-16-le")) // 2 <= 4000 for p in parts)
        assert parts == split_message(t)
    assert got[len(texts) - 3] == []                   # empty input: no part


def test_read_notes_keeps_whole_files(spark, tmp_path):
    folder = tmp_path / "20_Sources"
    folder.mkdir()
    (folder / "my note+1.md").write_bytes(b"---\r\ntitle: T\r\n---\r\nbody\r\nmore")
    (folder / "plain.md").write_text("---\ntitle: P\n---\nx\ny\n")
    got = {r.name: (r.fm["title"], r.md) for r in N.ingest_notes(N.read_notes(spark, str(folder))).collect()}
    assert got == {"my note+1.md": ("T", "---\ntitle: T\n---\nbody\nmore"), "plain.md": ("P", "---\ntitle: P\n---\nx\ny\n")}


def _notes(spark, items):
    df = spark.createDataFrame(items, "path string, md string")
    return N.ingest_notes(df)


def test_front_matter_and_missing_fields(spark):
    md_ok = '---\ntitle: "A"\nsource_url: https://a\nsource_type: x\ncaptured_at: 1\nstatus: inbox\n---\nbody'
    md_bad = '---\ntitle: \nsource_url: https://a: b\nsource_url: https://c\n---\ntext'
    notes = _notes(spark, [("/v/20_Sources/a.md", md_ok), ("/v/20_Sources/b.md", md_bad),
                           ("/v/20_Sources/c.md", "no front matter")])
    fm = {r.path: r.fm for r in notes.collect()}
    assert fm["/v/20_Sources/a.md"]["title"] == "A"
    assert fm["/v/20_Sources/b.md"]["source_url"] == "https://c"          # later key wins
    miss = {r.path: r.missing for r in N.missing_fields(notes).collect()}
    assert miss == {"/v/20_Sources/b.md": ["title", "source_type", "captured_at", "status"],
                    "/v/20_Sources/c.md": ["title", "source_url", "source_type", "captured_at", "status"]}


def test_duplicates_and_unsynthesised(spark):
    notes = _notes(spark, [
        ("/v/10_Raw/one.md", "see https://dup.example/x."),
        ("/v/10_Raw/two.md", "https://dup.example/x, https://solo.example"),
        ("/v/50_Synthesis/s.md", "links one.md and [[two]] without the extension"),
        ("/v/20_Sources/src.md", "---\ntitle: An agent note\n---\n"),
    ])
    d = N.duplicate_urls(notes).collect()
    assert [(r.url, r.n_notes) for r in d] == [("https://dup.example/x", 2)]
    un = sorted(r.path for r in N.unsynthesised(notes).collect())
    assert un == ["/v/10_Raw/two.md"]
    s = N.lint_summary(notes).collect()[0]
    assert (s.total_notes, s.source_notes, s.raw_notes, s.duplicate_urls) == (4, 1, 2, 1)
    assert s.promote == ["/v/20_Sources/src.md"] and s.unsynthesised == ["/v/10_Raw/two.md"]
    assert not s.ok
