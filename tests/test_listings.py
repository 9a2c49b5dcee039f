"""Listing pages, link choice and the publication stream."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import listings
from tidemark.streaming import publications

HTML = """<html><body><a href="/news-and-publications/apra-insight">APRA Insight</a>
<ul><li><a href="/news-and-publications/issue-one-2026"> Issue  <b>One</b> </a> 15 April 2026</li>
<li><a class="x" href='/news-and-publications/issue-two'>Issue Two</a><span>2026-01-31</span></li>
<li><a href="/news-and-publications/issue-three">Issue Three &amp; more</a> 1/12/2025</li>
<li><a href="/news-and-publications/issue-two">again</a></li><li><a href="/about">About</a></li><li><a href="/news-and-publications/empty"> </a></li></ul></body></html>"""


def test_listing_entries(spark):
    pages = spark.createDataFrame([(1, HTML)], "page_id long, html string")
    got = {r.url.rsplit("/", 1)[-1]: (r.title, r.published_date) for r in listings.listing_entries(pages, listings.APRA_INSIGHT).collect()}
    assert got == {"issue-one-2026": ("Issue One", dt.date(2026, 4, 15)), "issue-two": ("Issue Two", dt.date(2026, 1, 31)),
                   "issue-three": ("Issue Three & more", dt.date(2025, 12, 1))}


def test_dates_beside_below_and_above_links(spark):
    item = "/news-and-publications/"
    html = (f'<article><h3><a href="{item}a">A</a></h3><p>15 April 2026</p></article><ul><li><span>1 May 2026</span><div><a href={item}b>B</a></div></li>'
            f'<li><a href="{item}c"><div>C</div></a><time datetime="2026-06-02">June</time></li></ul>'
            f'<section><p><a href="{item}d">D</a> 3 July 2026</p><p><a href="{item}e">E</a> 4 July 2026</p></section>'
            f'<section>5 July 2026 <a href="{item}f">F</a> 6 July 2026 <a href="{item}g">G</a></section>'
            f'<article><a href="mailto:x@y.z">Mail</a><a href="javascript:go()">Go</a><a href="{item}h">H\u00a0h</a></article>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = {r.title: r.published_date for r in listings.listing_entries(pages, listings.APRA_INSIGHT).collect()}
    day = lambda m, d: dt.date(2026, m, d)
    assert got == {"A": day(4, 15), "B": day(5, 1), "C": day(6, 2), "D": day(7, 3), "E": day(7, 4), "F": day(7, 5), "G": day(7, 5), "H h": None}


def test_glob_and_vetoes(spark):
    links = spark.createDataFrame([(1, 0, "/a/Report_Q4_2025.pdf?x=1", "Download"), (1, 1, "/b/other.pdf", "Pillar 3 disclosure"), (1, 2, "/c/report_q3.pdf", "presentation")],
                                  "page_id int, n int, href string, title string").withColumn("pos", F.struct("n"))
    rules = [listings.LinkRule("glob", "report_q?_*.pdf", ("pillar",), ".pdf"), listings.LinkRule("words", "nothing*", ("pillar 3",), ".pdf"),
             listings.LinkRule("veto", "*.pdf*", ("report",), ".pdf", ("download", "pillar", "presentation"))]
    got = {r.target: (r.link, r.matched_by) for r in listings.tiered_link_match(links, rules, ["page_id"], F.lit("https://s.example/x/y")).collect()}
    assert got == {"glob": ("https://s.example/a/Report_Q4_2025.pdf?x=1", "primary-glob"), "words": ("https://s.example/b/other.pdf", "fallback-keywords")}


def test_stream_emits_each_url_once_across_batches(spark, tmp_path):
    base = str(tmp_path)
    for n, html in enumerate(('<a href="/x">X</a><a href="/y">Y</a>', '<a href="/x">X</a><a href="/z">Z</a>')):
        html += '<a href="mailto:a@b.c">Mail</a><a href="rel">R</a>'
        spark.createDataFrame([(n, "https://s.example/d/p?q", html)], publications.PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
        publications.publication_stream(spark, f"{base}/in", f"{base}/out", f"{base}/cp").awaitTermination()
    assert sorted(r.url for r in spark.read.schema("url string, title string").parquet(f"{base}/out").collect()) == [f"https://s.example/{u}" for u in ("d/rel", "x", "y", "z")]


def test_a_header_date_belongs_to_no_entry_below_it(spark):
    item = "/news-and-publications/"
    html = (f'<div><p>Page updated 1 May 2026</p><div><a href="{item}a">A</a><p>15 (16) April 2026</p></div><div><a href="{item}b">B</a><p>17 April 2026</p></div>'
            f'<ul><li><h3><a href="{item}c">C</a></h3></li></ul></div>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = {r.title: r.published_date for r in listings.listing_entries(pages, listings.APRA_INSIGHT).collect()}
    assert got == {"A": dt.date(2026, 5, 1), "B": dt.date(2026, 4, 17), "C": None}


def test_broken_pages():
    assert listings.links_of("") == [] and listings.links_of("a < b <3 > <") == []
    deep = "<div>" * 3000 + '<a href="x">deep</a>'
    assert listings.links_of(deep) == [("x", "deep", "", "")]
    page = '<p>1/2/2024<a href="&#47;u?a=1&amp;b" title=">">U &amp; <b>V</a></p></i><a href=w>W <a href=\'z\'>Z<script>"</a>2020-01-01"</script><!-- 3 May 2024 -->'
    assert listings.links_of(page) == [("/u?a=1&b", "U & V", "1/2/2024", ""), ("w", "W", "", ""), ("z", "Z", "", "")]
    wide = "".join(f'<li><a href="{i}">t{i}</a> {i % 28 + 1} May 2024</li>' for i in range(20_000))
    got = listings.links_of(f"<ul>{wide}</ul>")
    assert len(got) == 20_000 and got[5] == ("5", "t5", "6 May 2024", "1 May 2024")


def test_links_join_the_address_of_their_page(spark):
    import urllib.parse as u

    base = ["https://s.example/d/p?q#f", "https://s.example", "http://s.example/d/"]
    hrefs = ["/x", "rel/y", "?z=1", "//other.example/a", "https://t.example/b", "mailto:a@b", "#top", "javascript:go()"]
    rows = spark.createDataFrame([(b, h) for b in base for h in hrefs], "b string, h string")
    got = {(r.b, r.h): r.u for r in rows.select("b", "h", listings.X.absolute_url(F.col("b"), F.col("h")).alias("u")).collect()}
    assert got == {(b, h): None if h.split(":")[0] in ("mailto", "javascript") else u.urljoin(b, h) for b in base for h in hrefs}


def test_manifest_merges_by_url_and_replays_cleanly(spark, tmp_path):
    path, day = f"{tmp_path}/m", dt.date(2026, 5, 1)
    schema = "source_key string, url string, title string, published_date date"
    make = lambda *rows: spark.createDataFrame([("s", u, t, d) for u, t, d in rows], schema)
    first = make(("u1", "one", day), ("u2", "two", None), ("u2", "again", None), (None, "no address", day))
    second = make(("u1", "renamed", day), ("u3", "three", dt.date(2026, 6, 1)))
    for batch, rows in ((0, first), (1, second), (1, second), (0, first)):
        listings.manifest_append(rows, path, batch)
    items = listings.manifest_items(spark, path, first.schema).collect()
    assert [(r.url, r.title) for r in items] == [("u3", "three"), ("u1", "one"), ("u2", "again")]
    assert listings.manifest_items(spark, f"{tmp_path}/none", first.schema).count() == 0
