import html
import re

import pytest

from leaguelake.llm import html_density as h

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<div id="top"><a href=/>Home</a> <a href=/x>About</a></div><header><h1>Site name</h1></header>
<div class="cookie-notice">We use cookies to make everything better, do you accept all of them?</div>
<div class="wrap"><div class="content"><h1>Head &amp; line</h1><p>First paragraph with <a href=#>a link</a> and text that
 is long enough.<p>Short.</p><ul><li>One item of text<li>Two items</ul><p>Second&nbsp;paragraph, also reasonably long to count.</p></div>
<div class="side-bar"><h3>Latest</h3><ul><li><a href=a>Story one is here</a></li><li><a href=b>Story two</a></li></ul></div></div>
<form><label>Name</label><input></form><section id="comments"><p>Nice article, I liked it a lot, very well written.</p></section>
<div class="ad">Buy this now</div><footer>&copy; site</footer></body></html>"""
TEXT = (
    "Head & line\nFirst paragraph with a link and text that is long enough.\nShort.\nOne item of text\nTwo items\n"
    "Second paragraph, also reasonably long to count."
)


def test_article_without_its_surroundings():
    assert h.main_text(PAGE) == TEXT


@pytest.mark.parametrize("tag", ["article", "main", 'div role="main"', 'section class="article-body"'])
def test_article_elements(tag):
    name = tag.split()[0]
    page = f"<body><nav><a href=/>Home</a></nav><{tag}><header><h1>Title</h1></header><p>One.</p><aside>Side</aside><p>Two.</p></{name}><p>After</p></body>"
    assert h.main_text(page) == "Title\nOne.\nTwo."


def test_defined_cases(spark):
    rows = [
        (1, "u", None), (2, "u", ""), (3, None, "<p>one<p>two"), (3, None, "<p>one<p>two"), (None, "u", "no tags at all"),
        (5, "u", "<article><p>cut in the mid"), (6, "u", "<article><p>whole words</p></artic"), (7, "u", "<script>only code"),
        (8, "u", "<div>" * 50_000 + "deep" + "</div>" * 50_000), (9, "u", "<p>" + "word " * 200_000 + "</p>"), (10, "u", "<form><p>All in a form.</p></form>"),
    ]
    pages = spark.createDataFrame([(*r, "x", 3) for r in rows], "page_id bigint, url string, html string, text string, n_chars int")
    got = [(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in h.extract(pages).collect()]
    texts = ["", "", "one\ntwo", "one\ntwo", "no tags at all", "cut in the mid", "whole words", "", "deep", ("word " * 200_000).strip(), "All in a form."]
    assert got == [(r[0], r[1], t, len(t)) for r, t in zip(rows, texts)]
    assert h.extract(pages.limit(0)).count() == 0


def test_pages_of_the_tables(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in h.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"<[a-z/][^>]*$", "", body))
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", p.replace("<br>", " "))).split()) for p in parts]
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)


def test_nothing_of_the_article_is_lost():
    body = "<p>A paragraph of the article that is long enough to be told from what lies around it.</p>"
    for part, text in (
        ("<ul><li><a href=1>First source</a></li><li><a href=2>Second source</a></li></ul>", "First source\nSecond source"),
        ("<table><tr><td><a href=1>Cell one</a></td><td><a href=2>Cell two</a></td></tr></table>", "Cell one\nCell two"),
        ("<blockquote class='comment'>What the minister said to the press.</blockquote>", "What the minister said to the press."),
        ("<div class='related-work'><p>Earlier studies came to another result.</p></div>", "Earlier studies came to another result."),
        ("<p class='form-text'>The form has three parts.</p>", "The form has three parts."),
        ("<section class='social-history'><p>The town grew quickly.</p></section>", "The town grew quickly."),
    ):
        got = h.main_text(f"<body><nav><a href=/>Home</a></nav><article><h1>T</h1>{body}{part}{body}</article></body>")
        assert text in got and got.count("A paragraph") == 2, part
    for part in (
        "<div class='related'><a href=1>Another story to read</a> <a href=2>More</a></div>", "<section id='comments'><p>Nice one, thanks for it.</p></section>",
        "<div class='share'><a href=1>Share this</a></div>", "<div class='ad'>Buy now</div>",
    ):
        got = h.main_text(f"<body><article><h1>T</h1>{body}{part}{body}</article></body>")
        assert got.split("\n") == ["T", re.sub("<.*?>", "", body), re.sub("<.*?>", "", body)], part


def test_time_grows_with_the_depth():
    import time

    def seconds(depth):
        page = "<body>" + "<div>" * depth + "deep</section></b>" * 2000 + "</div>" * depth
        start = time.process_time()
        assert h.main_text(page).startswith("deep")
        return time.process_time() - start

    seconds(1000)
    assert seconds(40_000) < 8 * seconds(10_000) + 1
