import itertools
import random

import pytest

from tablehaul.llm import html_text as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1><a href=/>Home</a></header><nav><ul><li><a href=a>News</a><li><a href=b>Sport</a></ul></nav>
<div class="notice">We use cookies on this site, and by reading on you accept them all.</div>
<article><h1>Big &amp; title</h1><p>First   paragraph of the
story is here, and it goes on.<p><b>Second</b> one<br>goes on&nbsp;too, with <a href=q>a link</a>.<!-- <p>no</p> -->
<div class="ad">Buy our very good things now, they are cheap and they are good.</div><p>Is.</p>
<script>var a = "<p>x</p>";</script></article><aside><p>A related story that is long, with a lot of words in it.</p></aside>
<div id="comments"><p>I really liked this article, thank you so much for writing it all.</p></div>
<form><p>Subscribe to our letter, for updates on all topics every week.</p></form>
<footer>&copy; 2024 all rights are kept by us and by others.</footer></body></html>"""


def test_page():
    assert H.main_text(PAGE) == ("Big & title\nFirst paragraph of the story is here, and it goes on.\n"
                                 "Second one goes on too, with a link.\nIs.")


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<script>x", "<!-- x", "</p></div>", "<nav>a b c</nav>", "&", "<a<b>"])
def test_pages_without_content(page):
    assert H.main_text(page) == ""


def brute(odds, edges):
    best = None
    for labels in itertools.product((False, True), repeat=len(odds)):
        cost = sum(max(0, o) if not x else max(0, -o) for o, x in zip(odds, labels))
        cost += sum(w for i, j, w in edges if labels[i] != labels[j])
        best = cost if best is None else min(best, cost)
    return best


def test_cut_is_minimal():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 9)
        odds = [rng.uniform(-2, 2) for _ in range(n)]
        edges = [(i, j, rng.uniform(0, 1.5)) for i, j in itertools.combinations(range(n), 2) if rng.random() < 0.4]
        labels = H.min_cut(odds, edges)
        cost = sum(max(0, o) if not x else max(0, -o) for o, x in zip(odds, labels))
        cost += sum(w for i, j, w in edges if labels[i] != labels[j])
        assert abs(cost - brute(odds, edges)) < 1e-9


def test_smoothness_keeps_a_short_block_among_content():
    body = "<div><p>A long paragraph of text with many words, which is surely content.</p>%s<p>A second long paragraph with many words in it too.</p></div>"
    assert "\nShort\n" in H.main_text(body % "<p>Short</p>")
    beside = "<div><p>Short</p></div><article><p>A long paragraph of text with many words, which is surely content.</p></article>"
    assert "Short" not in H.main_text(beside)
    assert H.main_text("<div><p>Short</p></div>") == "Short"  # nothing else is there


@pytest.mark.parametrize("inner, text", [
    ("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> hold.</p>", "Let x=2 hold."),
    ("<noscript><p>A picture of the sea, for those without scripts.</p></noscript>", "A picture of the sea, for those without scripts."),
    ("<p>Before <svg><path d='M0 0'/><text>drawn</text></p><p>After the drawing that nobody closed.</p>", "Before\nAfter the drawing that nobody closed."),
    ("<p>Icon <svg viewBox='0 0 1 1'><title>t</title><g><path/></g></svg> shown.</p><svg/>", "Icon shown."),
    ("<div class=notice>The notice that the town had put up is quoted here.</div>", "The notice that the town had put up is quoted here."),
    ("<p class=legal>The law says so, in its third part.</p>", "The law says so, in its third part."),
    ("<h2 class=related>What else is known</h2>", "What else is known"),
    ("<div id=left-side>On the left side stood a house.</div>", "On the left side stood a house."),
    ("<p class='ad'>Buy now, it is cheap.</p>", None), ("<div class='share-buttons'>Share this with all your friends.</div>", None),
    ("<section id=comments><p>A reader said that this was very good.</p></section>", None)])
def test_what_an_article_holds(inner, text):
    page = f"<article><h1>Title</h1><p>The story begins here, with a good many words.</p>{inner}<p>And here it ends, with some more of them.</p></article>"
    lines = ["Title", "The story begins here, with a good many words.", *([text] if text else []), "And here it ends, with some more of them."]
    assert H.main_text(page) == "\n".join(lines)


@pytest.mark.parametrize("page, text", [("<p>One.</p>", "One."), ("just text", "just text"), ("<noscript>Turn scripts on, please.</noscript>", ""),
                                        ("<nav>One</nav>", ""), ("<p><a href=x>One link</a></p>", ""), ("<svg>a", "")])
def test_short_pages(page, text):
    assert H.main_text(page) == text


def test_very_long_page():
    page = "<article>" + "".join(f"<p>para {i} of many." for i in range(20000)) + "</article>"
    assert H.main_text(page).count("\n") == 19999


def test_frame(spark):
    rows = [(1, "u", PAGE, "c"), (1, "u", PAGE, "c"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = H.extract(df)
    assert got.columns == ["page_id", "url", "text"]
    assert sorted(len(r.text) for r in got.collect()) == [0, len(H.main_text(PAGE)), len(H.main_text(PAGE))]
    assert H.extract(df.limit(0)).count() == 0


def test_query_matches_the_articles(spark, sf_dir):
    import html
    import re

    from tablehaul.llm.queries import QUERIES
    want = {}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1].replace("<br>", " ")
        lines = (" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner))
        want[r.page_id] = "\n".join(x for x in lines if x)
    rows = QUERIES["op4_html_extraction"](spark, sf_dir).collect()
    assert {r.page_id: r.text for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)
