"""Main text of pages, by hand and on the given table."""

import html
import os
import re

import pytest

from tidemark.llm import main_text as M

SMALL = "/root/testdata/sf0.01"
WEIGHTS = M.Weights({"": 0.2, "body": 0.2}, {m: -20.0 for m in ("article", "main", "/article", "/main")})


def text(page):
    return M.main_text(page, WEIGHTS)


def test_boilerplate_of_all_kinds_is_left_out():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{x:y}</style></head><body class="has-sidebar"><header><h1>Site</h1><nav><a href=x>Home</a></nav></header>
<div id="wrap" class="layout sidebar-left"><aside>side words here and more</aside><div class="cookie-notice">We use cookies to do all</div>
<article class="post"><header class="entry-header"><h1>Title one</h1></header><p>First <b>bo</b>ld &amp; brave &lt;tag&gt; para.<!-- <p>no</p> --><ul><li>one</li>
<li>two <a href="a>b">link</a></li></ul><script>var t="</p>";</script><div class="ad-slot">Buy now cheap</div><p>Last words a < b.</p><form><label>Name</label></form></article>
<section id="comments"><p>Reader says a lot of words in this comment right here okay yes so many words it could win over all</p></section></div><footer>&copy; x</footer></body></html>"""
    assert text(page) == "Title one First bold & brave <tag> para. one two link Last words a < b."


def test_odd_pages():
    assert [text(x) for x in (None, "", "<p></p>", "<script>only()</script>", "<nav>menu</nav>")] == [""] * 5
    assert text("<p>a&nbsp;b\n\t c<br>d</p><p>e") == "a b c d e"
    assert text("<P>Unclosed <b>bold<P>next &amp;amp; &am") == "Unclosed bold next &amp; &am"
    assert text("<p>words before a cut tag <a href='x") == "words before a cut tag"
    long = "word " * 50_000
    assert text(f"<article><p>{long}</p></article>") == long.strip()


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables absent")
def test_given_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in M.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        body = re.sub(r"<[a-z/][^>]*(>|\Z)", "", re.sub(r"<(p|br|h1|/p|/h1)>", " ", re.sub(r"</?b>", "", body)))
        want = " ".join(html.unescape(body).split())
        assert got[r.page_id] == (want, len(want))


def test_table_edges(spark):
    rows = [(1, "u", "<p>same words</p>", "x", 1), (1, "u", "<p>same words</p>", "x", 2), (None, None, None, "x", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    assert sorted(((r.page_id, r.text, r.n_chars) for r in M.extract(pages).collect()), key=str) == [(1, "same words", 10), (1, "same words", 10), (None, "", 0)]
    assert M.extract(pages.limit(0)).count() == 0


def test_content_is_not_cut_by_names():
    inside = "<article><h2 id='related-work'>Related work</h2><section id='search'><p>one two</p></section><div class='social'>three four</div>" \
             "<div class='ad'>buy this</div><p>five six</p></article>"
    assert text(f"<body><p>menu</p>{inside}</body>") == "Related work one two three four five six"


@pytest.mark.parametrize("tag", ["article", "main"])
@pytest.mark.parametrize("block", [
    '<section id="comments">', '<div id="disqus_thread">', '<div class="comment-thread">', '<div class="sidebar">', '<ul class="menu">', '<div class="footer">',
    '<div class="cookie-popup">', '<div class="newsletter">', '<p class="sponsored">', '<div class="x post-comments">', '<div role="complementary">', '<aside>', '<div class="ad">'])
def test_known_blocks_inside_content_are_left_out(tag, block):
    body = " ".join(f"word{i}" for i in range(200))
    name, tail = block[1:].split()[0].strip("<>"), " ".join(f"tail{i}" for i in range(20))
    page = f"<body><{tag}><h1 id='menu'>Head</h1><p>{body}</p>{block}not of the text</{name}><p class='with-sidebar'>{tail} <span class='comment'>here</span></p></{tag}></body>"
    assert text(page) == f"Head {body} {tail} here"


def test_fieldset_around_the_body_is_a_wrapper():
    body = " ".join(f"word{i}" for i in range(50))
    assert text(f"<body><nav>menu</nav><form><fieldset><p>{body}</p></fieldset></form></body>") == body
    assert text(f"<body><p>{body}</p><form><fieldset><label>Name</label></fieldset></form></body>") == body


def test_forms_around_content_are_wrappers():
    menu = "<nav>menu words</nav><form id='s'><label>Find words</label><input name=q></form>"
    assert text(f"<body><form id='aspnetForm' class='search'><nav>menu</nav><article><p>body of the page</p></article><footer>end</footer></form></body>") == "body of the page"
    assert text(f"<body>{menu}<form action='x'><div><p>most of the words of this page lie in here</p></div></form></body>") == "most of the words of this page lie in here"
    assert text("<p>plain text of the page</p><form><label>Your name</label></form>") == "plain text of the page"
    assert text("<div><form><p>word</p></div>" * 20_000).startswith("word")


def test_short_marks_beside_and_within_content_stay():
    long = " ".join(["word"] * 60)
    for a, b in ((long, "short second one"), ("short first one", long)):
        assert text(f"<body><p>x</p><article><p>{a}</p></article><hr><article><p>{b}</p></article><p>y</p></body>") == f"{a} {b}"
    assert text(f"<body><p>x</p><main><p>an intro</p><article><p>{long}</p></article></main><p>y</p></body>") == f"an intro {long}"
    assert text(f"<body><article><p>{long}</p></article><div class='related'><article><p>a teaser</p></article></div></body>") == long


def test_labelled_pages_overrule_words(spark):
    rows = [(i, "u", f"<body><p>menu</p><article><div class='social'><p>body {i}</p></div></article></body>") for i in range(30)]
    rows.append((99, "u", "<body><div class='social'><p>all of the text lies here</p></div></body>"))
    rows.append((98, "u", "<body><p>some plain text here</p><div class='related'><p>other things</p></div></body>"))
    got = {r.page_id: r.text for r in M.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[98] == "some plain text here" and got[99] == "all of the text lies here" and got[7] == "body 7"
