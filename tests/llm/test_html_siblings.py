"""Text is found by scores, whatever the tags around it are called."""

import pytest

from tunewright.llm import html as H

from .test_html import JUNK, PROSE, TAIL


@pytest.mark.parametrize("tag", ["article", "main", "div", "section"])
def test_lead_and_end_beside_the_main_part(tag):
    parts = f"<section><p>Lead. {PROSE}</p></section><{tag}><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p></{tag}><div><p>End. {PROSE}</p></div>"
    page = f"<body>{JUNK}<div>{parts}</div>{TAIL}</body>"
    assert H.main_text(page).split("\n\n") == [f"Lead. {PROSE}", *[PROSE] * 3, f"End. {PROSE}"]


def test_teasers_are_no_text():
    teasers = "".join(f"<article><h3><a href=/{i}>Other story {i}</a></h3><p><a href=/{i}>Read more</a></p></article>" for i in range(4))
    page = f"<body><div><p>{PROSE}</p><p>{PROSE}</p></div><div>{teasers}</div></body>"
    assert H.main_text(page) == f"{PROSE}\n\n{PROSE}"
