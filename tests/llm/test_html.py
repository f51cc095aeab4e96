import re
from html import unescape

import pytest

from tunewright.llm import html as H

PROSE = "The quick brown fox, which was tired, jumped over the dog, and slept all day long in the sun."
JUNK = """<nav><a href=/>Home</a></nav><div id="header">Site name, best site, ever</div>
<div class="cookie-notice"><p>We use cookies, many cookies, for you, and for us, and for all our partners.</p></div>"""
TAIL = """<aside><p>Side text, long enough, to be a paragraph, with commas, and more.</p></aside>
<div class="sidebar-content"><p>More side text, with commas, again, and again, and again.</p></div>
<div class="ad"><p>Buy now, buy cheap, buy more, and more, and more, and more.</p></div>
<section id="comments"><article class="comment"><p>I disagree, strongly, with all, of this, text, sorry.</p></article></section>
<form><p>Your name, please</p><input></form><footer><p>All rights, reserved, forever.</p></footer><script>var a="<p>x</p>";</script>"""


@pytest.mark.parametrize(
    "wrap",
    ["<article>{}</article>", "<main>{}</main>", '<div class="post-content has-sidebar">{}</div>', "<div><div>{}</div></div>"],
)
def test_boilerplate_goes(wrap):
    body = f"<h1>Title</h1><p>{PROSE}</p><h2>Part</h2><p>{PROSE}<br>Second\n line</p><ul><li>one</li><li>two</li></ul>"
    page = f"<html><head><title>T</title></head><body>{JUNK}{wrap.format(body)}{TAIL}</body></html>"
    assert H.main_text(page).split("\n\n") == ["Title", PROSE, "Part", f"{PROSE} Second line", "one", "two"]


def test_sections_and_siblings():
    parts = "".join(f"<section><h2>S{i}</h2><p>{PROSE}</p></section>" for i in range(3))
    links = "<div><a href=a>one link here</a> <a href=b>another link there</a></div>"
    page = f"<body><div>{parts}<p>Short end.</p></div>{links}</body>"
    want = [x for i in range(3) for x in (f"S{i}", PROSE)] + ["Short end."]
    assert H.main_text(page).split("\n\n") == want
    two = f"<body><article><p>{PROSE}</p></article><article><p>B, c.</p></article></body>"
    assert H.main_text(two) == f"{PROSE}\n\nB, c."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("   ", ""), ("plain &amp; simple", "plain & simple"),
        ("<p>a&lt;b &#233; &nbsp; x</p>", "a<b é x"), ("<p>one<p>two<div>three", "one\n\ntwo\n\nthree"),
        ("<p><b>one<br><p>two</b> three</p>", "one\n\ntwo three"),
        ("<p>a<!-- no > --> b</p><!-- open", "a b"), ("<p>a</p><script>if (a<b) '</p>'", "a"),
        ("<p>x</b></i></div></p>y", "x\n\ny"), ("<article><p>Hi.</p></article><div class=ad>" + PROSE + "</div>", "Hi."),
        ("<article><header><h1>T</h1></header><p>Hi.</p></article>", "T\n\nHi."),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
        ("<p>a <span hidden>no</span><i style='display: none'>no</i>b</p>", "a b"),
        ("<p>a < b and 3<4</p>", "a < b and 3<4"), ("<div>a<span>b</span>c</div>", "abc"),
        ("<p>x</p><svg/><p>y</p>", "x\n\ny"), ("<nav>only</nav>", ""),
    ],
)
def test_small_pages(page, text):
    assert H.main_text(page) == text


def test_deep_and_long_pages():
    assert H.main_text("<div>" * 20_000 + "deep") == "deep"
    assert H.main_text("<b>" * 3000 + "x" + "</b>" * 3000) == "x"
    assert H.main_text("<p>" + "word, " * 100_000) == ("word, " * 100_000).strip()
    assert H.main_text("<" * 50_000) == "<" * 50_000


def article(page):
    a = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    out = []
    for part in re.split(r"</?(?:p|h1)>", a):
        t = re.sub(r"<[^>]+>", "", part.replace("<br>", " "))
        t = re.sub(r"\s+", " ", unescape(t)).strip()
        if t:
            out.append(t)
    return "\n\n".join(out)


def test_query_equals_the_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    want = {r.page_id: (r.url, article(r.html)) for r in pages}
    got = H.op2_html_tree_scoring(spark, "/root/testdata/sf0.01").collect()
    assert {r.page_id: (r.url, r.text) for r in got} == want and len(got) == len(pages)
    assert all(r.n_chars == len(r.text) for r in got)


def test_nulls_copies_and_empty_table(spark):
    rows = [(1, None, "x"), (2, "<p>a</p>", "x"), (2, "<p>a</p>", "x")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    assert sorted((r.page_id, r.text, r.n_chars) for r in H.extract(df).collect()) == [(1, "", 0), (2, "a", 1), (2, "a", 1)]
    assert H.extract(df.limit(0)).count() == 0
