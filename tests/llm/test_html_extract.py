import html
import re

import pytest

from venuescope.llm.html_blocks import page_blocks
from venuescope.llm.html_extract import extract, main_text
from llm_fixtures import SF

P1 = "The committee said that the new rules will be in force from the first day of the year, and that they are not for all."
P2 = "It was the third time in a month that the board had to meet on the question of what is to be done with the old bridge."
P3 = "None of them would say when the work is to begin, but they have the money for it."
COMMENT = "I do not think that this is the way to do it, and I have been in the trade for as long as he has."


def page(body):
    return f"<!DOCTYPE html><html><head><title>The title of the page</title><style>p{{margin:0}}</style></head><body>{body}</body></html>"


LAYOUTS = {
    "article": f"<header><a href='/'>Home of the news</a></header><nav><ul><li><a href=/a>The a</a><li><a href=/b>The b</a></ul></nav>"
               f"<article><h1>Old bridge</h1><p>{P1}<p>{P2}</p><p>So.</p><div class='ad'>{COMMENT}</div><p>{P3}</article>"
               f"<aside><p>{COMMENT}</p></aside><section id=comments><h2>Comments</h2><p>{COMMENT}</p></section><footer>&copy; The news</footer>",
    "divs": f"<div id=top-nav><a href=/>Home</a> | <a href=/n>News</a></div><div class='cookie-notice'><p>{COMMENT}</p></div>"
            f"<div class=post><h1>Old bridge</h1><p>{P1}</p><p>{P2}</p><p>So.</p><script>var t = '</p>';</script><p>{P3}</p></div>"
            f"<div class=comments><div><p>{COMMENT}</p></div></div><form action=/s><input><p>Sign up for the letter of the week and the month</p></form>"
            f"<div class='site-footer'><p>All rights are with the owners of the site and their heirs</p></div>",
    "table": f"<table><tr><td class=sidebar><a href=/1>one</a><br><br><a href=/2>two</a></td><td><h2>Old bridge</h2><p>{P1}</p>"
             f"<p>{P2}</p><p>So.</p><p>{P3}</p></td></tr></table><p><a href=/x>The way to the archive of all the news that we have</a></p>",
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts_give_the_article_alone(layout):
    assert main_text(page(LAYOUTS[layout])) == "\n\n".join(["Old bridge", P1, P2, "So.", P3])


def test_references_white_space_and_broken_markup():
    body = "<article><p>a&nbsp;&amp;&lt;b&gt; &#233;&#x2014;\n\t c<br>d<br><br/>e <b>f</b>g<!-- x --><p title='a > b'>h < 3<p>i &am"
    assert main_text(page(body).replace("</body></html>", "")) == "a &<b> é— c d\n\ne fg\n\nh < 3\n\ni &am"
    assert main_text("<article><p>cut <b") == "cut"
    assert main_text("<article>x<script>never closed <p>y") == "x"
    assert main_text("<p>short one") == "short one"
    assert main_text("<div class=ad>unclosed<article><p>" + P1) == P1
    assert main_text("<article><p><a href=/x>open link<p>" + P1 + "</article>").endswith(P1)
    for raw in (None, "", "   ", "<html></html>", "<!-- only -->", "<nav>the menu of the site</nav>"):
        assert main_text(raw) == ""


def test_ambiguous_blocks_follow_their_neighbours():
    """Without containers: short blocks beside good ones are kept, short ones beside link lists go."""
    links = "".join(f"<p><a href=/{i}>the link to the page of the number {i}</a></p>" for i in range(3))
    body = f"{links}<p>Menu</p>{links}<p>{P1}</p><p>Yes.</p><p>{P2}</p>{links}<p>More</p>{links}"
    assert main_text(page(body)) == "\n\n".join([P1, "Yes.", P2])


def test_names_that_only_mention_something_else():
    body = f"<div class='has-sidebar with-comments'><div id=postHeader><h1>Old bridge</h1></div><div class=entry-content><p>{P1}</p></div>" \
           f"<div class='sidebar'><p>{COMMENT}</p></div></div>"
    assert main_text(page(body)) == "Old bridge\n\n" + P1


def test_blocks_know_their_place():
    b = page_blocks("<main><h1>T</h1><p>x <a href=/>yy</a></p><footer>f</footer></main>z")
    assert [(x.text, x.linked, x.heading, x.region, x.beside) for x in b] == [
        ("T", 0, True, 1, False), ("x yy", 2, False, 1, False), ("f", 0, False, 1, True), ("z", 0, False, 0, False)]


def test_long_and_deep_pages_take_linear_time():
    deep = "<div>" * 20000 + "<p>" + P1 + "</p>" + "</b></i>" * 20000
    assert main_text(deep) == P1
    assert main_text('<p a="' * 30000 + P1).count("a") < 10**6
    words = "the and of " * 100000
    assert main_text(f"<article><p>{words}</article>") == words.strip()
    assert main_text("<" * 50000 + "</" * 50000 + ">" + "&" * 50000 + P1).endswith(P1)


def plain_article(page):
    """The article of a test page by plain replacement."""
    body = re.search(r"<article>(.*?)(?:</article>|$)", page or "", re.S)
    if not body:
        return ""
    lines = re.sub(r"<[^>]*>?", "", re.sub(r"</?(?:p|h1|br)>", "\n", body[1])).split("\n")
    lines = [" ".join(html.unescape(x).split()) for x in lines]
    return "\n\n".join(x for x in lines if x)


def test_whole_table_and_messy_rows(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    out = {r.page_id: r for r in extract(pages).collect()}
    rows = pages.collect()
    assert len(out) == len(rows)
    for r in rows:
        assert out[r.page_id].text == plain_article(r.html)
        assert out[r.page_id].n_chars == len(out[r.page_id].text) and out[r.page_id].url == r.url
    odd = spark.createDataFrame([(None, None, None, 1, "t"), (1, "u", "", 2, "t"), (1, "u", "<p>\U0001f600 x", 3, "t"), (1, "u", "<p>\U0001f600 x", 3, "t")],
                                "page_id long, url string, html string, n int, text string")
    assert sorted([tuple(r) for r in extract(odd).collect()], key=str) == sorted(
        [(None, None, "", 0), (1, "u", "", 0), (1, "u", "\U0001f600 x", 3), (1, "u", "\U0001f600 x", 3)], key=str)
    assert extract(odd.limit(0)).count() == 0
