"""Feed documents of any kind: order of children, limits, reasons."""

import pytest

from curation.sources.feed_reader import feed_entries, read_feeds
from curation.sources.feeds import repo_stars

RSS = """<rss xmlns:content="urn:c"><channel><title> The &amp;amp; feed </title>
<item><title>no url</title><guid>tag:x</guid></item>
<item><link></link><link>https://a.example/1?utm_source=x</link><description> </description>
 <content:encoded>&lt;p&gt;one&lt;/p&gt;&lt;script&gt;x&lt;/script&gt;two</content:encoded><summary>late</summary><pubDate>d1</pubDate></item>
<item><guid>https://a.example/2</guid><title><b>bold</b> title</title><description>a  b
 c</description></item><item><link>https://a.example/3</link></item></channel><item><link>https://root.example/</link></item></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>At</title><link href="https://self.example/"/>
<entry><link rel="self" href="https://s.example/"/><link href="https://alt.example/"/><updated>u</updated><content>later</content></entry>
<entry><link rel="related" href="https://r.example/"/><summary>s &lt; t</summary></entry><entry><link rel="alternate"/></entry></feed>"""


def test_rss_in_document_order():
    got = list(feed_entries(RSS, 20))
    assert [e["url"] for e in got] == ["https://a.example/1?utm_source=x", "https://a.example/2", "https://a.example/3"]
    assert [e["pos"] for e in got] == [0, 1, 2] and {e["feed_title"] for e in got} == {"The & feed"}
    assert got[0]["body"] == "one\ntwo\nd1" and got[0]["title"] == got[0]["url"] and got[0]["published"] == "d1"
    assert got[1]["title"] == "bold title" and got[1]["body"] == "a b c"
    assert [e["url"] for e in feed_entries(RSS, 1)] == ["https://a.example/1?utm_source=x"]


def test_atom_links_and_root_items():
    got = list(feed_entries(ATOM, 20))
    assert [(e["url"], e["body"]) for e in got] == [("https://alt.example/", "later\nu"), ("https://r.example/", "s < t")]
    assert [e["url"] for e in feed_entries("<rdf><channel/><ITEM><link>https://x.example/</link></ITEM></rdf>", 5)] == ["https://x.example/"]
    assert list(feed_entries("<html><body/></html>", 5)) == []


def test_one_bad_feed_fails_nothing(spark):
    configs = spark.createDataFrame([(1, "u1", None, None), (2, None, 5, 1), (3, "u3", 5, 1), (4, "u4", 0, 1), (5, "", 5, 1),
                                     (6, "u6", 5, 1), (7, "u7", 2, 1)], "idx int, url string, limit int, priority int")
    fetched = spark.createDataFrame([("u1", RSS), ("u3", "<rss><a></rss>"), ("u4", RSS), ("u6", ""), ("u7", ATOM), ("u9", ATOM)],
                                    "feed_url string, xml string")
    rows = read_feeds(configs, fetched).orderBy("idx", "pos").collect()
    assert [(r.idx, r.url) for r in rows if r.warning is None] == [
        (1, "https://a.example/1?utm_source=x"), (1, "https://a.example/2"), (1, "https://a.example/3"),
        (7, "https://alt.example/"), (7, "https://r.example/")]
    assert rows[0].canonical_url == "https://a.example/1"
    assert {r.idx: r.warning for r in rows if r.warning} == {
        2: "rss_feed_skipped:2: missing url", 5: "rss_feed_skipped:5: missing url",
        3: "rss_feed_failed:u3: mismatched tag: line 1, column 10", 6: "rss_feed_failed:u6: no element found: line 1, column 0"}
    assert read_feeds(configs.limit(0), fetched).count() == 0


@pytest.mark.parametrize("limit", [0, -1])
def test_no_stars_keep_the_columns(spark, limit):
    pages = spark.createDataFrame([(1, '[{"html_url": "https://x.example/"}]')], "page_no int, json string")
    none = repo_stars(pages, limit)
    assert none.columns == repo_stars(pages, 1).columns and none.count() == 0
