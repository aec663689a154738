import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from blogweave.operators import extract, favourites, profiles
from blogweave.sources.dims import DEFAULT_SITES, sites_frame

NOW = dt.datetime(2015, 3, 18, 12, 0)
POST_PAGE = """<html><head><title>T / Доступ</title><link rel="canonical" href="http://habrahabr.ru/post/42/"></head>
<body><div class="post shortcuts_item" id="post_42">
<div class="published">сегодня в 10:05</div>
<h1 class="title"><span class="post_title">Hello &amp; bye</span><span class="flag flag_tutorial">t</span>
<span class="flag flag_sandbox">s</span></h1>
<div class="hubs"><a class="hub" href="http://habrahabr.ru/hub/python/">Python</a>
<a class="hub" href="http://habrahabr.ru/company/acme/blog/">Acme</a>
<a class="hub" href="http://habrahabr.ru/company/zeta/blog/">Zeta</a></div>
<div class="content html_format">  <p>One<br>two &lt;3</p>  </div>
<ul class="tags"><li><a href="#">a</a></li><li><a href="#">b</a></li></ul>
<div class="views-count_post">1205</div><span class="js-favs_count">7</span><span class="js-score">–3</span>
</div>
<div class="author-info"><a href="/users/alice/">alice</a></div>
<div id="comments"><h2 class="title">Комментарии <span id="comments_count">4</span></h2>
<div class="comment_item"><div class="comment_body "><div class="author_banned">x</div></div>
  <div class="reply_comments">
    <div class="comment_item"><div class="comment_body "><div class="info"><a class="username" href="/users/bob/">bob</a>
      <time>вчера в 23:00</time><a class="link_to_comment" href="#c2">#</a>
      <div class="voting"><span class="score">–2</span></div></div><div class="message html_format"><p>hi</p></div></div>
      <div class="reply_comments"></div></div>
  </div>
  <div class="reply_comments">
    <div class="comment_item"><div class="comment_body "><div class="info"><a class="username" href="/users/carl/">carl</a></div></div></div>
  </div>
</div>
<div class="comment_item"><div class="comment_body"><p>no exact body class</p></div>
  <div class="reply_comments"><div class="comment_item"><div class="comment_body "><a class="username">lost</a></div></div></div></div>
<div class="comment_item"><div class="comment_body "><a class="username" href="/users/dan/">dan</a></div></div>
</div></body></html>"""


def _pages(spark, *pages):
    return spark.createDataFrame([(i, u, NOW, h) for i, (u, h) in enumerate(pages)],
                                 "page_id long, url string, fetched_at timestamp_ntz, html string")


def _raw(spark, *pages):
    return extract.extract_post_pages(_pages(spark, *pages))


def _comments(spark, *pages):
    return extract.comments_from_pages(extract.extract_comment_pages(_pages(spark, *pages)))


def test_post_fields(spark):
    raw = _raw(spark, ("http://habrahabr.ru/post/42", POST_PAGE))
    p = extract.posts_from_pages(raw, sites_frame(spark, DEFAULT_SITES)).first()
    assert (p._id, p.blog_id, p.post_id, p.url) == ("habrahabr/42", "habrahabr", 42, "http://habrahabr.ru/post/42/")
    assert p.title == "Hello & bye" and p.published == dt.datetime(2015, 3, 18, 10, 5)
    assert p.flags == ["tutorial", "sandbox"] and p.hub_ids == ["python"] and p.company_blog == "zeta"
    assert p.content_html == "<p>One<br>two &lt;3</p>"
    assert p.tags == ["a", "b"] and (p.pageviews, p.favs_count, p.voting_score) == (1205, 7, -3)
    assert p.author_user == "alice" and p.comments_count == 4


def test_comment_tree_paths_and_skips(spark):
    c = _comments(spark, ("http://habrahabr.ru/post/42/", POST_PAGE))
    got = rows(c.select(F.array_join(F.transform("path", lambda x: x.cast("string")), ".").alias("p"),
                        "banned", "username", "votes", "time", "message_html"))
    assert got == [("0", True, None, None, None, None),
                   ("0.0", False, "bob", -2, dt.datetime(2015, 3, 17, 23, 0), "<p>hi</p>"),
                   ("0.1", False, "carl", None, None, None),          # second reply container continues numbering
                   ("1", False, "dan", None, None, None)]             # body-less item skipped with its replies


def test_missing_container_and_bad_id_are_dead_letters(spark):
    bad = POST_PAGE.replace('id="post_42"', 'id="article_42"')
    raw = _raw(spark, ("http://habrahabr.ru/x/", "<html><body><p>nothing</p></body></html>"),
               ("http://habrahabr.ru/y/", bad))
    assert extract.posts_from_pages(raw, sites_frame(spark, DEFAULT_SITES)).count() == 0
    lost = extract.post_dead_letters(raw, sites_frame(spark, DEFAULT_SITES))
    assert rows(lost, "page_id", "error") == [(0, "no post container"), (1, "bad post id")]


def test_every_page_ends_in_a_record_or_a_dead_letter(spark):
    deep = POST_PAGE.replace("<p>One", "<b>" * 5000 + "<p>One")
    pages = [("http://habrahabr.ru/a/", POST_PAGE), ("http://habrahabr.ru/b/", POST_PAGE.replace(' id="post_42"', "")),
             ("http://habrahabr.ru/c/", POST_PAGE.replace("post_42", "post_" + "9" * 20)), ("http://habrahabr.ru/d/", deep),
             ("http://habrahabr.ru/e/", POST_PAGE.replace("<p>One", "<![foo[ x ]]><p>One")), ("u", None), ("u", ""), ("u", "<" * 500 + "<a <b '\"")]
    pages.append(("http://other.ru/f/", POST_PAGE.replace("habrahabr.ru/post/42", "other.ru/post/42")))
    raw, sites = _raw(spark, *pages), sites_frame(spark, DEFAULT_SITES)
    found = {r.page_id for r in extract.posts_from_pages(raw, sites).collect()}
    lost = {r.page_id: r.error for r in extract.post_dead_letters(raw, sites).collect()}
    assert found == {0, 3, 4} and set(lost) == set(range(9)) - found
    assert [lost[i] for i in (1, 2, 5, 6, 7, 8)] == ["no post id", "bad post id", "no post container", "no post container",
                                                     "no post container", "unknown host"]


def test_comments_and_scripts_stay_in_the_content(spark):
    page = POST_PAGE.replace("<p>One<br>two &lt;3</p>", "a<!-- cut -->b<script>if (a<b && c) {}</script>&amp;")
    p = extract.posts_from_pages(_raw(spark, ("http://habrahabr.ru/post/42/", page)), sites_frame(spark, DEFAULT_SITES)).first()
    assert p.content_html == "a<!-- cut -->b<script>if (a<b && c) {}</script>&amp;"


def test_participants_of_a_page(spark):
    raw = extract.extract_post_pages(_pages(spark, ("http://habrahabr.ru/post/42/", POST_PAGE)), participants=True)
    p = extract.posts_from_pages(raw, sites_frame(spark, DEFAULT_SITES)).first()
    assert p.users_participated == ["alice", "bob", "carl", "dan"]


USER_PAGE = """<html><head><link rel="canonical" href="http://habrahabr.ru/users/bob/"></head><body>
<div class="user_header"><a class="avatar" href="/users/bob/"><img src="/i/bob.png"></a>
<h2 class="username"><a href="/users/bob/"> bob </a></h2>
<div class="karma"><div class="num">–12,5</div></div><div class="rating"><div class="num">n/a</div></div></div>
<div class="user_profile"><div class="fullname"> Bob B </div>
<dl><dt>Зарегистрирован:</dt><dd>3 марта 2012 по приглашению <a href="/users/x/">x</a></dd></dl>
<dl><dt>Активность:</dt><dd>Последний раз был на сайте сегодня в 09:00</dd></dl>
<dl id="working_in"><dt>Работает в:</dt><dd><ul><li><a href="/company/acme/">A</a></li><li>none</li></ul></dd></dl>
<dl><dt>Состоит в:</dt><dd><ul><li><a href="/hub/go/">Go</a></li><li><a href="/other/">?</a></li></ul></dd></dl>
<dl><dt>Интересы:</dt><dd><a>go</a>, <a>rust</a></dd></dl>
<dl><dt>Город:</dt><dd>Omsk</dd></dl><dl><dt>Город:</dt><dd><b>Tomsk</b></dd></dl>
<dl><dt>Пустое:</dt><dd><br></dd></dl><dl><dd>no label</dd></dl>
</div></body></html>"""


def test_user_profile_dispatch(spark):
    df = spark.createDataFrame([(1, "http://habrahabr.ru/users/bob/", NOW, USER_PAGE)],
                               "page_id long, url string, fetched_at timestamp_ntz, html string")
    u = profiles.user_profiles(profiles.extract_profile_pages(df), sites_frame(spark, DEFAULT_SITES)).first()
    assert (u._id, u.username, u.fullname) == ("habrahabr/bob", "bob", "Bob B")
    assert u.avatar_url == "http://habrahabr.ru/i/bob.png"
    assert u.karma == -12.5 and u.rating is None
    assert u.registration_date == dt.datetime(2012, 3, 3) and u.last_activity == dt.datetime(2015, 3, 18, 9, 0)
    assert u.working_companies == ["acme"] and u.hubs == ["go"] and u.tags == ["go", "rust"]
    info = {e.key: e.value for e in u.info}
    assert info == {"Город": "<b>Tomsk</b>", "Пустое": "<br>"}       # repeated key keeps the last value


def test_favourite_edges(spark):
    page = ('<html><body><h2 class="username"><a href="/users/bob/">bob</a></h2><div class="user_favorites">'
            '<div class="post"><a class="post_title" href="http://habrahabr.ru/post/5/">a</a></div>'
            '<div class="post"><a class="post_title" href="http://geektimes.ru/post/6/">b</a></div>'
            '<div class="post"><a class="post_title" href="/post/7/">relative</a></div>'
            '<div class="post"><a class="post_title" href="http://habrahabr.ru/post/5/">dup</a></div>'
            '<div class="post"><a class="post_title" href="http://other.ru/post/8/">c</a></div>'
            '<div class="post"><span>none</span></div></div>'
            '<div class="post"><a class="post_title" href="http://habrahabr.ru/post/99/">beside the list</a></div></body></html>')
    df = spark.createDataFrame([("http://habrahabr.ru/users/bob/favorites/", page)], "url string, html string")
    sites = sites_frame(spark, DEFAULT_SITES)
    assert rows(favourites.favourite_edges(df, sites)) == [
        ("bob", "geektimes/6"), ("bob", "habrahabr/5"), ("bob", "habrahabr/7")]
    assert rows(favourites.favourite_dead_letters(df, sites), "error") == [("unknown host",)]


OLD_PAGE = """<html><head><title>Old</title></head><body><div class="post" id="post_640">
<div class="published">2 мая 2009 в 07:45</div><h1 class="title"><span class="post_title">A lamp</span></h1>
<div class="hubs"><a class="hub" href="http://habrahabr.ru/hub/light/">Light</a></div>
<div class="content html_format"><p>glow</p></div><ul class="tags"><li><a>lamp</a></li></ul>
<div class="infopanel"><div class="pageviews">77</div><div class="favs_count">6</div>
<div class="author"><a href="http://habrahabr.ru/users/wick/">wick</a><span class="rating">–1,5</span></div></div>
</div><div id="comments"><h2 class="title"><span id="comments_count">4</span></h2></div></body></html>"""


def test_older_markup_fallbacks(spark):
    raw = _raw(spark, ("http://habrahabr.ru/post/640/", OLD_PAGE))
    p = extract.posts_from_pages(raw, sites_frame(spark, DEFAULT_SITES)).first()
    assert (p.post_id, p.pageviews, p.favs_count, p.comments_count) == (640, 77, 6, 4)
    assert (p.author, p.author_url, p.author_rating) == ("wick", "http://habrahabr.ru/users/wick/", -1.5)
    assert p.content_html == "<p>glow</p>" and p.content_outer_html == '<div class="content html_format"><p>glow</p></div>'
    assert p.published == dt.datetime(2009, 5, 2, 7, 45) and p.updated_at == NOW


def test_pages_to_collection_to_ranking(spark, tmp_path):
    """Rendered post pages → extraction → keyed collection → participant
    ranking from the stored arrays equals the ranking from the tables."""
    from pyspark.sql import functions as F

    from blogweave.fixtures import render
    from blogweave.operators import corpus
    from blogweave.operators.collection import KeyedCollection
    from blogweave.fixtures.views import comments_view, posts_view
    from blogweave.sources.dims import sites_frame
    from conftest import SF001
    posts, comments = posts_view(spark, SF001), comments_view(spark, SF001)
    extracted = extract.posts_from_pages(extract.extract_post_pages(render.post_pages(posts, comments), participants=True),
                                         sites_frame(spark))
    records = extracted.select("_type", "_id", "updated_at", F.lit(0).cast("long").alias("seq"),
                               "blog_id", "post_id", "users_participated")
    coll = KeyedCollection(spark, str(tmp_path / "posts"), buckets=4)
    coll.merge(records)
    stored = coll.read()
    assert stored.count() == posts.count()
    from_docs = corpus.participant_activity(corpus.unwind_participants(stored), sites_frame(spark))
    from_tables = corpus.participant_activity(
        corpus.pairs_with_blog(posts, corpus.participant_pairs(posts, comments)), sites_frame(spark))
    assert from_docs.collect() == from_tables.collect()


def test_broken_nesting_in_comments(spark):
    page = ('<html><head><link rel="canonical" href="http://habrahabr.ru/post/5/"></head><body>'
            '<div class="post" id="post_5"><div class="content"><p>a<b>b<p>c</div></div>'
            '<div id="comments">'
            '<div class="comment_item"><div class="comment_body "><a class="username">x</a>'
            '<div class="message"><p>open <b>bold</div></div>'
            '<div class="reply_comments"><div class="comment_item"><div class="comment_body ">'
            '<a class="username">y</a><div class="message">ok</div></div></div></div></div>'
            '<div class="comment_item"><div class="comment_body "><a class="username">z</a></div></div>'
            '</div></body></html>')
    raw = _raw(spark, ("http://habrahabr.ru/post/5/", page))
    p = extract.posts_from_pages(raw, sites_frame(spark, DEFAULT_SITES)).first()
    assert p.post_id == 5 and p.content_html == "<p>a<b>b<p>c"      # as written
    got = rows(_comments(spark, ("http://habrahabr.ru/post/5/", page)).select(
        F.array_join(F.transform("path", lambda x: x.cast("string")), "."), "username", "message_html"))
    assert got == [("0", "x", "<p>open <b>bold"), ("0.0", "y", "ok"), ("1", "z", None)]
