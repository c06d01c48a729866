"""Main text: pages of many shapes, and a plain version on marked pages."""

import html
import random
import re
import time

import numpy as np
import pytest

from curation.llm import main_text

BODY = ["A title", "First paragraph with enough words to look like an article, and some more words.",
        "Short one.", "Second paragraph that goes on for a while, with a link in it and other words besides.",
        "Third paragraph, again of some length so that the lines about it are smoothed upwards."]
MENU = "<ul><li><a href=/a>Home</a><li><a href=/b>News</a><li><a href=/c>About us</a></ul>"


def article(body=BODY):
    return f"<h1>{body[0]}</h1>" + "".join(f"<p>{p}</p>" for p in body[1:])


WANT = "\n".join(BODY)


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title><style>p{{}}</style></head><body><nav>{MENU}</nav><article>{article()}</article><footer>f</footer>",
    f"<body><header>Site<p>slogan</header><main>{article()}<aside>see also<p>more</aside></main><footer>(c)</footer></body>",
    f"<body><div id=menu>{MENU}</div><div class='content'>{article()}</div><div id=footer>(c) us</div></body>",
    f"<body><div class=page><div class=nav>{MENU}</div>{article()}<div class='cookie-notice'>We use cookies, a lot of them, all day</div></div>",
    f"<article><header><h1>{BODY[0]}</h1></header>" + "".join(f"<p>{p}" for p in BODY[1:]) + "<footer>tags</footer></article>",
    f"<article>{article()}<section class=comments><article class=comment>Nice words from a reader, many of them</article></section></article>",
    f"<article>{article()}<div class='ad'>Buy this thing now</div><form>Your mail<input><button>Go</button></form></article>",
    f"<nav>{MENU}<article>{article()}",
    f"<div class='advert'><p>Buy</div><noscript><p>no script</noscript><article>{article()}<script>var x='<p>no</p>'</script></article>",
    f"<main><h1>{BODY[0]}</h1><article>{article()[len(BODY[0]) + 9:]}</article><p class='share'>share it</p></main>",
    f"<article><div class='article-header'><h1>{BODY[0]}</h1></div>{article()[len(BODY[0]) + 9:]}<div hidden>x</div></article>",
    f"<ARTICLE>{article()}<span class=ad>buy</span></ARTICLE><aside><article>Another teaser of some words</article></aside>",
    f"<body class='has-comments sidebar-left'><div role=navigation>{MENU}</div><article class='post has-sidebar'>{article()}</article>",
    f"<body><div class=menu>{MENU}</div><h1>{BODY[0]}</h1>" + "".join(f"<div>{p}</div>" for p in BODY[1:]) + "<div id=usercomments>nice</div>",
])
def test_shapes(page):
    assert main_text.main_text(page) == WANT


def test_a_long_block_is_no_region():
    long = "many words of one long paragraph " * 40
    page = f"<body><div id=nav>{MENU}</div><div class=text><h1>Head</h1><p>short</p><p>{long}</p><p>end</p></div></body>"
    assert main_text.main_text(page) == f"Head\nshort\n{long.strip()}\nend"


def test_signs_and_white_space():
    page = "<article><p>a &lt;b&gt; &amp;amp; &eacute;&nbsp;x\n\t y<br>z &#x41; 1 < 2 <b>bo</b>ld<!-- no --></p>\n<p> </p></article>"
    assert main_text.main_text(page) == "a <b> &amp; é x y z A 1 < 2 bold"
    assert main_text.main_text("<table><tr><td>a<td>b</tr><tr><td>c</table>") == "a b\nc"
    assert [main_text.main_text(x) for x in (None, "", " \n", "<p></p>", "plain words")] == ["", "", "", "", "plain words"]


def plain(page):
    body = re.search(r"(?s)<article>(.*?)(?:</article>|\Z)", page).group(1)
    parts = [re.sub(r"<[^>]*>", "", p.replace("<br>", " ")) for p in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)


def test_extract(spark):
    rnd = random.Random(1)
    pages = []
    for i in range(200):
        words = [" ".join(rnd.choice(["the", "and", "naïve", "&amp;", "x;", "<b>"]) for _ in range(rnd.randint(0, 60)))
                 for _ in range(rnd.randint(1, 9))]
        pages.append(f"<head><title>t</title></head><body><nav>{MENU}</nav><article>{article(words)}" +
                     rnd.choice(["</article><footer>x</footer>", "</article>", ""]))
    rows = [(i, p, "own", 1) for i, p in enumerate(pages)] + [(None, None, None, None), (0, pages[0], "own", 1)]
    df = spark.createDataFrame(rows, "page_id long, html string, text string, n_chars int").repartition(3)
    got = main_text.extract(df)
    assert got.columns == ["page_id", "text", "n_chars"]
    want = [(i, plain(p) if p else "") for i, p, *_ in rows]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(str((i, t, len(t))) for i, t in want)
    assert main_text.extract(df.limit(0)).count() == 0


def test_smoothing():
    x = np.array([0.0, 0, 10, 0, 0, 0, 0, 3])
    sigma = main_text.SMOOTH
    for i, v in enumerate(main_text.smoothed(x)):
        w = [np.exp(-(i - j) ** 2 / (2 * sigma ** 2)) if abs(i - j) <= int(3 * sigma) + 1 else 0 for j in range(len(x))]
        assert abs(v - np.dot(w, x) / sum(w)) < 1e-9
    assert len(main_text.smoothed(np.ones(1))) == 1


@pytest.mark.parametrize("piece", ["<", "<a ", "<script>", "<!--", "</", '<a x="', '<a x=">" ', "&", "<meta x ", "<![CDATA[",
                                   "<?", "<!", "<title>", "&#", "&a", "<nav>", "<a b='>", "<![foo[ x ]>", "<div class=ad>x"])
def test_hostile_pages_take_linear_time(piece):
    began = time.process_time()
    main_text.main_text(piece * (400_000 // len(piece)))
    assert time.process_time() - began < 4
