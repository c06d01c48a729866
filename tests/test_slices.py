"""Texts in slices: bounds, and scans that send results on slice by slice."""

import pyarrow as pa

from curation.functions import html as H
from curation.functions.slices import SLICE_BYTES, slice_bounds
from curation.operators.chunk import chunk_documents, route_documents, split_page


def test_slices_cover_every_row_and_hold_few_bytes():
    texts = pa.array(["é" * 30, None, "", "a" * 500, "b", None, "c" * 60, "d" * 41, ""])
    got = list(slice_bounds(texts[1:], 100))
    assert got == [(0, 2), (2, 3), (3, 6), (6, 8)]
    assert list(slice_bounds(texts[:0])) == []


def test_chunks_are_rows_of_one_python_step(spark):
    texts = ["x" * 5000, None, "", "a\n\n" * 2000, " "]
    df = spark.createDataFrame([(i if i else None, f"k{i}", t) for i, t in enumerate(texts)], "doc int, k string, text string")
    out = chunk_documents(df, "text", ["k", "doc"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan
    got = sorted((r.k, r.doc, r.part_no, r.part, r.part_chars) for r in out.filter("doc is not null").collect())
    assert got == [(f"k{i}", i, n, p, len(p)) for i, t in enumerate(texts) if i for n, p in enumerate(split_page(t or ""))]
    assert [r.part_chars for r in out.filter("doc is null").orderBy("part_no").collect()] == [1800, 1800, 1400]
    routed = route_documents(df, "text", ["k"], full_below=10, light_above=5500, segment=3000)
    assert routed.columns == ["k", "route", "part_no", "part"]
    assert sorted((r.k, r.part_no, r.part) for r in routed.filter("route = 'segmented'").collect()) \
        == [("k0", 0, "x" * 3000), ("k0", 1, "x" * 2000)]


def test_page_scans_send_results_on_by_slices():
    page = "<html><title>T&amp;{}</title><body>" + "x" * 400_000 + "</body></html>"
    texts = pa.array([page.format(i) for i in range(20)] + [None, "<title>z"])
    for scan, fields in ((H._page_parts, ["title", "description", "text"]), (H._collected, ["title", "desc"])):
        taken, rows = [], []

        def batches():
            taken.append(1)
            yield texts
            taken.append(2)
            yield texts[:0]
        for part in scan.func(batches()):
            assert sum(len(x or "") for r in part.to_pylist() for x in r.values()) <= SLICE_BYTES and taken == [1]
            rows += part.to_pylist()
        assert [r["title"] for r in rows] == [f"T&{i}" for i in range(20)] + ["", ""] and [*rows[0]] == fields
