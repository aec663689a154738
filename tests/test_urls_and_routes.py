from conftest import rows
from pyspark.sql import functions as F

from blogweave.functions import urls as U
from blogweave.operators import frontier
from blogweave.sources.dims import DEFAULT_SITES, sites_frame


def _one(spark, expr, *values):
    df = spark.createDataFrame([(v,) for v in values], "u string")
    return [r[0] for r in df.select(expr(F.col("u"))).collect()]


def test_ids_from_urls(spark):
    assert _one(spark, U.company_id, "http://h.ru/company/yandex/blog/1/", "http://h.ru/x/") == ["yandex", None]
    assert _one(spark, U.user_id, "http://h.ru/users/bob/", "http://h.ru/users/bob") == ["bob", None]
    assert _one(spark, U.hub_id, "http://h.ru/hub/python/") == ["python"]


def test_post_id_is_last_numeric_segment_followed_by_slash(spark):
    got = _one(spark, U.post_id, "http://h.ru/company/x/blog/12/345/", "http://h.ru/post/77",
               "http://h.ru/post/77/", "http://h.ru/99999999999999999999/")
    assert got == [345, None, 77, None]          # strict form; overflow → null
    assert _one(spark, lambda c: U.post_id(c, loose=True), "http://h.ru/post/77") == [77]


def test_hub_term_needs_two_segments(spark):
    got = _one(spark, U.hub_term, "http://h.ru/", "http://h.ru/hub/", "http://h.ru/hub/apps_design/",
               "http://h.ru/a/hub/go/?x=1")
    assert got == [None, None, "hub_apps_design", "hub_go"]


def test_join_url_forms(spark):
    df = spark.createDataFrame([
        ("http://a.ru/x/y?q=1#f", "/p"), ("http://a.ru/x/y?q=1#f", "z"), ("http://a.ru", "z"),
        ("http://a.ru/x/y?q=1#f", "?k=2"), ("http://a.ru/x/y?q=1#f", "#g"), ("http://a.ru/x/y?q=1#f", ""),
        ("https://a.ru/x", "//b.ru/c"), ("http://a.ru/x", "mailto:m@a.ru"), ("http://a.ru/x", None),
    ], "b string, r string")
    got = [r[0] for r in df.select(U.join_url("b", "r")).collect()]
    assert got == ["http://a.ru/p", "http://a.ru/x/z", "http://a.ru/z", "http://a.ru/x/y?k=2",
                   "http://a.ru/x/y?q=1#g", "http://a.ru/x/y?q=1", "https://b.ru/c", "mailto:m@a.ru", None]


def test_host_lookup_unknown_host_is_dead_letter_not_failure(spark):
    df = spark.createDataFrame([("http://habrahabr.ru/post/1/",), ("http://other.ru/post/2/",),
                                ("http://habrahabr.ru:8080/post/3/",)], "url string")
    got = rows(U.with_url_ids(df, sites_frame(spark, DEFAULT_SITES)), "url", "blog_id", "host_known")
    assert got == [("http://habrahabr.ru/post/1/", "habrahabr", True),
                   ("http://habrahabr.ru:8080/post/3/", None, False),   # netloc keeps the port
                   ("http://other.ru/post/2/", None, False)]


def test_routes_first_match_deny_and_offsite(spark):
    urls = ["http://habrahabr.ru/post/5/", "http://habrahabr.ru/users/bob/topics/", "http://habrahabr.ru/users/bob/",
            "http://habrahabr.ru/company/my-co/profile/", "http://habrahabr.ru/company/myco/profile/",
            "http://m.habrahabr.ru/post/5/", "http://evil.com/post/5/", "http://sub.geektimes.ru/company/a/blog/1/"]
    df = spark.createDataFrame([(u,) for u in urls], "abs_url string")
    got = {r.abs_url: (r.route, r.on_site, r.denied) for r in frontier.route_links(df).collect()}
    assert got["http://habrahabr.ru/post/5/"] == ("post", True, False)
    assert got["http://habrahabr.ru/users/bob/topics/"][0] == "user_topics"
    assert got["http://habrahabr.ru/users/bob/"][0] == "user_profile"
    assert got["http://habrahabr.ru/company/my-co/profile/"][0] == "follow"        # \w excludes '-'
    assert got["http://habrahabr.ru/company/myco/profile/"][0] == "company_profile"
    assert got["http://m.habrahabr.ru/post/5/"] == ("follow", True, True)          # denied → follow only
    assert got["http://evil.com/post/5/"][1] is False                               # off-site
    assert got["http://sub.geektimes.ru/company/a/blog/1/"][0] == "post"


def test_pending_ids_retry_exceptions(spark):
    outcomes = spark.createDataFrame([(1, "stored"), (2, "404"), (3, "forbidden"), (4, "exception")],
                                     "page_id long, outcome string")
    got = [r.page_id for r in frontier.pending_pages(spark, outcomes, 0, 6).orderBy("page_id").collect()]
    assert got == [0, 4, 5]


def test_seeds_inclusive_range_times_sites(spark):
    bases = [b for _, _, b in DEFAULT_SITES]
    seeds = frontier.frontier_seeds(spark, 1, 2, bases)
    urls = {r.url for r in seeds.collect()}
    assert "http://habrahabr.ru/post/2" in urls and "http://geektimes.ru/post/1" in urls
    assert "http://megamozg.ru/top/" in urls and "http://tmfeed.ru/" in urls
    assert seeds.count() == 2 * 3 + 3 * 3 + 1


def test_explicit_post_id_seeds(spark):
    bases = [b for _, _, b in DEFAULT_SITES]
    ids = spark.createDataFrame([(7,), (9,)], "post_id long")
    seeds = frontier.frontier_seeds(spark, 1, 1, bases, post_ids=ids)
    assert {"http://habrahabr.ru/post/7/", "http://habrahabr.ru/post/9/"} <= {r.url for r in seeds.collect()}


def test_join_url_removes_dot_segments(spark):
    from urllib.parse import urljoin
    refs = ["../g", "./g", "g/./h", "g/../h", "..", "../../../g", "/./g", "/a/b/../c"]
    df = spark.createDataFrame([("http://a/b/c/d;p?q", r) for r in refs], "b string, r string")
    got = [r[0] for r in df.select(U.join_url("b", "r")).collect()]
    assert got == [urljoin("http://a/b/c/d;p?q", r) for r in refs]


def test_outcomes_and_usable_pages(spark):
    from blogweave.operators import pages
    restricted = "<html><head><title>Хабр / Доступ к странице ограничен</title></head><body><div class='post'>x</div></body></html>"
    ok = '<html><head><title>T</title></head><body><div class="post shortcuts_item" id="post_1">x</div></body></html>'
    no_title = '<html><body><div class="post">x</div></body></html>'
    empty = "<html><head><title>T</title></head><body><p>nothing</p></body></html>"
    df = spark.createDataFrame([(1, "u1", restricted, 200), (2, "u2", ok, 200), (3, "u3", no_title, 200),
                                (4, "u4", empty, 200), (5, "u5", "", 404), (6, "u6", ok, 500)],
                               "page_id long, url string, html string, status int")
    got = {r.page_id: (r.outcome, r.error) for r in frontier.extraction_outcomes(df).collect()}
    assert got == {1: ("forbidden", None), 2: ("stored", None), 3: ("stored", None),
                   4: ("exception", "no container element"), 5: ("404", None), 6: (None, None)}
    usable = [r.page_id for r in pages.usable_pages(df.where("status = 200")).orderBy("page_id").collect()]
    assert usable == [2, 3]
    pending = frontier.pending_pages(spark, frontier.extraction_outcomes(df), 1, 8)
    assert sorted(r.page_id for r in pending.collect()) == [4, 6, 7]


def test_canonical_link_any_attribute_order(spark):
    df = spark.createDataFrame([
        ('<head><link href="http://a/x/" rel="canonical"></head>', "u1"),
        ("<head><LINK rel='canonical' href='http://a/y/'></head>", "u2"),
        ('<head><link rel="stylesheet" href="s.css"></head>', "u3")], "html string, url string")
    got = [r[0] for r in df.select(U.canonical_url("html", "url")).collect()]
    assert got == ["http://a/x/", "http://a/y/", "u3"]


def test_anchor_href_quoting(spark):
    from blogweave.operators import pages
    html = """<p><a href="/a">A</a> <a class='post_title' href='/b'>B</a> <a href=/c>C</a> <a name="x">no</a></p>"""
    df = spark.createDataFrame([(1, "http://h.ru/p/", html)], "page_id long, url string, html string")
    got = [(r.pos, r.kind, r.href, r.abs_url, r.anchor_text) for r in pages.extract_links(df).orderBy("pos").collect()]
    assert got == [(0, "link", "/a", "http://h.ru/a", "A"), (1, "post", "/b", "http://h.ru/b", "B"),
                   (2, "link", "/c", "http://h.ru/c", "C")]


def test_anchors_with_other_attributes_and_without_end(spark):
    from blogweave.operators import pages
    html = """<a data-href="x" href="/y">Y</a><a href="/open">one<a title='a > b' href='/next?a=1&amp;b=2'>two <b>2</b></a> <A HREF="/up">U</A><a href="/last">end"""
    df = spark.createDataFrame([(1, "http://h.ru/p/", html)], "page_id long, url string, html string")
    got = [(r.href, r.anchor_text) for r in pages.extract_links(df).orderBy("pos").collect()]
    assert got == [("/y", "Y"), ("/open", "one"), ("/next?a=1&b=2", "two 2"), ("/up", "U"), ("/last", "end")]


def test_container_in_any_quoting(spark):
    from blogweave.operators import extract, pages
    html = ["<div class='post x'>", '<div id=1 class="a post">', "<div class=post>", "<div class='posts'>", "<div data-class='post'>", "<div class='p.ost'>"]
    df = spark.createDataFrame([(i, "http://h.ru/", h + "</div>") for i, h in enumerate(html)], "page_id long, url string, html string")
    assert [r.page_id for r in pages.usable_pages(df).orderBy("page_id").collect()] == [0, 1, 2]
    assert [r.found for r in extract.extract_post_pages(df).orderBy("page_id").collect()] == [True] * 3 + [False] * 3


def test_feed_links_on_feed_markup(spark):
    from blogweave.operators.scoped_links import FEED, scoped_links
    html = ('<div class="posts"><div class="post"><h1 class="title"><a class="post_title" href="/post/1/">A</a></h1></div>'
            '<div class="post"><h1 class="title"><a href="http://habrahabr.ru/post/2/" class="post_title">B</a></h1></div></div>'
            '<div class="post"><h1 class="title"><a class="post_title" href="/post/3/">outside the list</a></h1></div>'
            '<div class="page-nav"><ul id="nav-pages"><li><ul><li><a href="/all/page2/">2</a></li></ul></li><li><a href="page3/">3</a></li></ul></div>'
            '<a href="/users/x/">other</a>')
    df = spark.createDataFrame([(1, "http://habrahabr.ru/all/", html)], "page_id long, url string, html string")
    got = sorted((r.kind, r.abs_url) for r in scoped_links(df, FEED).collect())
    assert got == [("page", "http://habrahabr.ru/all/page2/"), ("page", "http://habrahabr.ru/all/page3/"),
                   ("post", "http://habrahabr.ru/post/1/"), ("post", "http://habrahabr.ru/post/2/")]


def test_url_identity(spark):
    same = {"http://h.ru/": ["http://h.ru", "HTTP://H.RU:80/", "http://h.ru/#top", "http://h.ru/?", "http://h.ru:"],
            "https://h.ru/post/1/?a=1&b=2": ["https://h.ru:443/post/1/?b=2&a=1", "https://h.ru/post/1/?a=1&b=2#comments", "https://h.ru/post/%31/?&a=1&&b=2"],
            "https://h.ru/%D0%BE~x?q=%2F": ["https://h.ru/%d0%be%7Ex?q=%2f"],
            "http://h.ru:443/a?b=&b=1&b%20=0": ["http://h.ru:443/a?b%20=0&b=1&b="],
            "http://h.ru/%": ["http://h.ru/%#x"], "mailto:a@b": ["mailto:a@b#x"], "/rel?b=1&a=2": ["/rel?b=1&a=2#f"]}
    for canonical, urls in same.items():
        assert _one(spark, U.identity, canonical, *urls) == [canonical] * (1 + len(urls))
    others = ["http://h.ru/post/1", "http://h.ru/post/1/", "http://h.ru/post/1/?a=1", "http://h.ru/post/1/?a=1&a=1", "https://h.ru/post/1/", "http://h.ru/Post/1/"]
    assert len(set(_one(spark, U.identity_key, *others))) == len(others)
    assert _one(spark, U.identity, None) == [None]
