"""Deep and unmatched markup in linear time, and scores by their definition on small trees."""

import random
import time

import pytest

from tunewright.llm import html as H

K = 200_000


@pytest.mark.parametrize(
    "page",
    [
        "<b>" * K + "</div>" * K,
        "<b>" * K + "<hr>" * K,
        "<b><div>" + "<i>" * K + "</b>" * K,
        "<table>" + "<td><span>" * (K // 2),
        "<b>" * K + "<header>" * K,
        "<li><em>" * (K // 2),
    ],
)
def test_linear_time(page):
    start = time.process_time()
    H.main_text(page + "<p>Some words, at the end.</p>")
    assert time.process_time() - start < 30


def test_siblings_at_every_depth():
    page = "<div><p>a, b</p>" * 20_000 + "<p>Words, and words, and more.</p>" + "</div><p>c, d</p>" * 20_000
    start = time.process_time()
    H.main_text(page)
    assert time.process_time() - start < 30


def test_unmatched_ends():
    assert H.main_text("<div><p>one <b>two</i></b> three</div></b></p>four") == "one two three\n\nfour"
    assert H.main_text("<b><div>one</b> two</div> three") == "one two\n\nthree"
    assert H.main_text("<ul><li>a<ul><li>b<li>c</ul><li>d</ul>") == "a\n\nb\n\nc\n\nd"


def slow_scores(root):
    """Points of each element, one definition at a time."""
    order = H._order(root)
    kept = lambda x: [c for c in x.children if isinstance(c, str) or not c.dropped]

    def texts(x, through):
        for c in kept(x):
            if isinstance(c, str):
                yield H._BLANK.sub(" ", c)
            elif through(c):
                yield from texts(c, through)

    size = lambda x: sum(len(t.strip()) for t in texts(x, lambda c: True))

    def links(x):
        return sum(size(c) if c.tag == "a" else links(c) for c in kept(x) if not isinstance(c, str))

    density = lambda x: links(x) / size(x) if size(x) else 0.0
    total = {id(x): 0.0 for x in order}
    for x in order:
        inline = list(texts(x, lambda c: c.tag not in H.BLOCK))
        n = sum(len(t.strip()) for t in inline)
        if not n or (x.tag not in H._PARAGRAPH and x is not root):
            continue
        points = (1 + sum(t.count(",") for t in inline) + min(n / 100, 3)) * (1 - density(x))
        if x.tag not in ("p", "td", "th", "li", "dd", "dt"):
            total[id(x)] += points
        up = x.parent
        for share in (1, 2, 6, 9, 12):
            if up is None:
                break
            total[id(up)] += points / share
            up = up.parent
    return [total[id(x)] * (1 - density(x)) for x in order]


def test_scores_by_definition():
    rng = random.Random(8)
    tags = "div p section ul li a b span article table td blockquote nav".split()
    for _ in range(300):
        page = ""
        for _ in range(rng.randrange(1, 40)):
            t = rng.choice(tags)
            page += rng.choice([f"<{t}>", f"<{t}>", f"</{t}>", "few words, ", "long text, with commas, and more " * 9])
        want = slow_scores(H.parse(page))
        root = H.parse(page)
        nodes = H._order(root)
        H.score(nodes)
        assert [x.score for x in nodes] == pytest.approx(want), page
