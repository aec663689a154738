"""No page and no URL ends or stalls a job."""

import time

from pyspark.sql import functions as F

from blogweave.functions import html as H
from blogweave.functions import markup as M
from blogweave.functions import urls as U
from blogweave.operators import extract, favourites, frontier, scoped_links
from blogweave.sources.dims import DEFAULT_SITES, sites_frame


def _texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "page_id long, html string").orderBy("page_id")


def test_long_urls_hosts_and_tag_runs(spark):
    urls = _texts(spark, "http://h.ru/" + "a/" * 100_000 + "12/", "http://h.ru/" + "1/" * 50_000, "http://h.ru/5//x/6/", "http://h.ru/7")
    assert [r[0] for r in urls.select(U.post_id("html")).collect()] == [12, 1, 5, None]
    hosts = _texts(spark, "http://" + "a." * 50_000 + "example.org/", "http://m.example.org/", "http://a..example.org/", "http://.example.org/",
                   "http://badexample.org/")
    routed = frontier.route_links(hosts.withColumnRenamed("html", "abs_url"), ["example.org"])
    assert [(r.on_site, r.denied) for r in routed.orderBy("page_id").collect()] == [
        (True, False), (True, True), (False, False), (False, False), (False, False)]
    deep = _texts(spark, "<b>" * 100_000 + "text", "<b><i>x</i></b>", "plain", None)
    assert [r[0] for r in deep.select(H.first_text("html")).collect()] == ["text", "x", "plain", None]


def test_broken_markup_takes_time_in_proportion(spark):
    pages = _texts(spark, "<a " * 350_000, "<div>" * 50_000, "<b></p>" * 40_000, '<a "' * 250_000, "<!--" * 250_000, "<script>" * 100_000, None, "")
    pages = pages.withColumn("url", F.lit("http://habrahabr.ru/post/1/"))
    start = time.time()
    assert [r[0] for r in pages.select(F.size(M.elements(M.tokens(F.col("html"))))).collect()] == [0, 50_000, 40_000, 0, 0, 0, None, 0]
    raw = extract.extract_post_pages(pages)
    assert extract.post_dead_letters(raw, sites_frame(spark, DEFAULT_SITES)).count() == 8
    assert extract.extract_comment_pages(pages).count() == 0
    assert [(r.page_id, r.kind, r.error) for r in scoped_links.scoped_links(pages, scoped_links.SIDE).collect()] == [(6, "error", "no html")]
    assert time.time() - start < 120


def test_tokens_cover_the_page(spark):
    pages = ['<p title="a > b">x</p><!-- <p> --><script>if (a<b) {"</p>"}</script>y < z<br/>', "<<<a<", "", "<!DOCTYPE html><p", "a<b c='"]
    got = _texts(spark, *pages).select(F.array_join(M.tokens(F.col("html")), "").alias("t"), M.tokens(F.col("html")).alias("k")).collect()
    assert [r.t for r in got] == pages
    assert got[0].k == ['<p title="a > b">', "x", "</p>", "<!-- <p> -->", '<script>if (a<b) {"</p>"}</script>', "y < z", "<br/>"]


def test_spans_and_selections(spark):
    page = "</div><DIV id=q><div class='c d'>in<a href=/u>t</a></div></i></div></div><div class=c><a>u</a></div><p class=c>open<a>v"
    df = _texts(spark, page).select(M.tokens(F.col("html")).alias("t")).select("t", M.elements(F.col("t")).alias("e"))
    r = df.select("e", M.all_texts(F.col("t"), M.path(F.col("e"), (None, "c", None), ("a", None, None))).alias("texts"),
                  M.all_texts(F.col("t"), M.path(F.col("e"), (None, None, "q"), (None, "d", None), ("a", None, None))).alias("chain"),
                  F.transform(M.first_inside(M.pick(F.col("e"), None, "c"), M.pick(F.col("e"), "a")), lambda x: x["i"]).alias("first"),
                  F.size(M.inside(M.pick(F.col("e"), "div"), M.pick(F.col("e"), "div"))).alias("nested")).first()
    assert [(e.name, e.cls, e.id) for e in r.e] == [("div", "", "q"), ("div", "c d", None), ("a", "", None), ("div", "c", None), ("a", "", None),
                                                    ("p", "c", None), ("a", "", None)]
    assert r.texts == ["t", "u", "v"] and r.chain == ["t"] and len(r.first) == 3 and r.nested == 1


def test_a_page_without_html_is_fetched_again(spark):
    pages = spark.createDataFrame([(1, None, 200), (2, '<div class="post">x</div>', 200), (3, None, 404)], "page_id long, html string, status int")
    got = frontier.extraction_outcomes(pages)
    assert [tuple(r) for r in got.orderBy("page_id").collect()] == [(1, "exception", "no html"), (2, "stored", None), (3, "404", None)]
    assert [r.page_id for r in frontier.pending_pages(spark, got, 1, 4).collect()] == [1]


def test_a_favourites_page_without_html_is_a_dead_letter(spark):
    pages = spark.createDataFrame([("http://habrahabr.ru/users/bob/favorites/", None)], "url string, html string")
    got = favourites.favourite_dead_letters(pages, sites_frame(spark, DEFAULT_SITES)).collect()
    assert [(r.post_url, r.error) for r in got] == [("http://habrahabr.ru/users/bob/favorites/", "no html")]
