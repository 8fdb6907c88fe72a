"""Plain tags read without the library parser, to the same elements."""

import random
from html.parser import HTMLParser

import pytest
from test_page_index import random_page

from jobsift.functions import html as H
from jobsift.operators import cards as X


def _shape(node):
    out, text = [], ""
    for c in node.children:
        if isinstance(c, str):
            text += c
            continue
        out += [text] * bool(text) + [(c.tag, c.attrs, c.number, c.nth, _shape(c))]
        text = ""
    return out + [text] * bool(text)


def _by_library(text):
    b = H._Builder()
    HTMLParser.feed(b, text)
    b.close()
    return b.root


ODD = ["<!-- a <b> c -->", "<!-- open", "<script>if (a < b) '<p>'</script>", "<STYLE>p > a</STYLE>", "<title>a &amp; <b>x</title>", "<br/>", "<p/>", "<DIV Class='x'>",
       '<a href="?a=1&amp;b=2&copy=3">', "<a href=x&y>", "<input disabled>", "a < b ", "&lt", "&amp;", "& ", "&nbsp;x", "</", "</ div>", "</div x>", "<", "<?php x ?>",
       "<![CDATA[ x ]]>", "<!DOCTYPE html>", '<p class="a" class="b">', '<p class="a>b">', '<p class="a"id="b">', "<li>one<li>two", "<table><tr><td>1<td>2<tr><td>3</table>",
       "<textarea><p></textarea>", "<h2 \n id='x'>", "<x-y z_1=\"2\">", "<p\tid=\"1\">", "\x00", "é\n  ü", "<noscript><p>n</noscript>", "<div data-id=\"job-card\">"]


@pytest.mark.parametrize("seed", range(60))
def test_plain_tags_give_the_elements_of_the_library_parser(seed):
    rng = random.Random(seed)
    parts = random_page(seed, 40).replace("<", "\n<").split("\n")
    for _ in range(seed % 20):
        parts.insert(rng.randrange(len(parts)), rng.choice(ODD))
    text = "".join(parts)
    assert _shape(H.parse(text)) == _shape(_by_library(text))


def test_a_plain_page_does_not_pass_the_library_parser(monkeypatch):
    fed = []
    real = H._Builder.feed
    monkeypatch.setattr(H._Builder, "feed", lambda self, text: fed.append(text) or real(self, text))
    cards = "".join(f'<div data-job-id="{i}"><a class="job-card-container__link" aria-label="T{i}" tabindex="0"></a> Q &amp; A</div>' for i in range(500))
    page = H.Page(f"<!DOCTYPE html><html><head><title>Jobs</title></head><body>{cards}</body></html>", X._LINKEDIN_RULES)
    assert len(page.found["title"]) == 500 and page.found["card"][7].text() == "Q & A"
    assert sum(map(len, fed)) < 60
