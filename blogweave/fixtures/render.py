"""Pages in the blog markup, rendered from tables (round-trip inputs).

The driver's ``pages`` hold generic web pages, so post, profile and
favourites pages are rendered here from the adapter views and the
``customer`` / ``supplier`` tables, then parsed back by the extraction
jobs and compared with SQL on the same tables.  Rendering is native
string building; the comment tree is rendered from the nested column
with one ``transform`` per level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blogweave.functions import fields as FD
from blogweave.fixtures.views import EPOCH
from blogweave.sources.dims import FIXTURE_DOMAIN

BANNED_TEXT = "НЛО прилетело и опубликовало эту надпись здесь"


def esc(c) -> Column:
    """HTML text escaping (``&``, ``<``, ``>``)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def attr_esc(c) -> Column:
    return F.replace(esc(c), F.lit('"'), F.lit("&quot;"))


def _opt(cond: Column, *parts) -> Column:
    return F.when(cond, F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])).otherwise(F.lit(""))


def _cat(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


ITEM_CLOSE = "</div></div>"

# A reply container of its own with an item without a body (the class lacks its
# trailing space): it and its reply are no comments and take no place.
BODILESS = ('<div class="reply_comments"><div class="comment_item"><div class="comment_body">gone</div><div class="reply_comments">'
            '<div class="comment_item"><div class="comment_body "><a class="username" href="/users/lost/">lost</a></div></div></div></div></div>')


def comment_open_html(fetched_at: Column) -> Column:
    """Opening markup of one comment (columns of the flat comment row),
    up to its open replies container."""
    t = F.col("time")
    live = _cat(
        '<div class="info">',
        _opt(F.col("username").isNotNull(), '<a class="username" href="/users/', attr_esc("username"), '/">',
             esc("username"), "</a>"),
        _opt(t.isNotNull(), "<time>", FD.render_site_datetime(t, fetched_at), "</time>"),
        _opt(F.col("link").isNotNull(), '<a class="link_to_comment" href="', attr_esc("link"), '">#</a>'),
        _opt(F.col("votes").isNotNull(), '<div class="voting"><span class="score">',
             FD.render_number(F.col("votes")), "</span></div>"),
        "</div>",
        _opt(F.col("message_html").isNotNull(), '<div class="message html_format">', F.col("message_html"), "</div>"))
    body = F.when(F.col("banned"), F.lit(f'<div class="author_banned">{BANNED_TEXT}</div>')).otherwise(live)
    return _cat('<div class="comment_item">', '<div class="comment_body ">', body, "</div>", _opt(F.col("comment_id") % 7 == 3, BODILESS),
                '<div class="reply_comments">')


def comments_html(comments: DataFrame, fetched: DataFrame) -> DataFrame:
    """``(post_id, comments_html)``: the comment tree markup of each post.

    No per-level passes: a post's comments in pre-order (lineage from
    pointer jumping), each opening followed by as many closings as the
    depth drops to the next comment.  One ``groupBy(post_id)``, whose
    group is the post's own comments (the page holds them all anyway).
    """
    from blogweave.operators import tree
    items = tree.preorder(comments.join(fetched, "post_id"), comment_open_html(F.col("fetched_at")))
    return items.select("post_id", tree.serialize_preorder("items", lambda v: v, ITEM_CLOSE)
                        .alias("comments_html"))


def fetch_time() -> Column:
    """Pages are fetched 0, 1 or 2 days after publication, so the three
    date forms (today, yesterday, full date) all occur."""
    return F.timestamp_add("DAY", F.col("post_id") % 3, F.col("published"))


def page_fetch_times(posts: DataFrame) -> DataFrame:
    return posts.select("post_id", fetch_time().alias("fetched_at"))


def post_pages(posts: DataFrame, comments: DataFrame | None) -> DataFrame:
    """Post pages ``(page_id, url, html, fetched_at)``, one per post."""
    posts, fetch = posts.withColumn("fetched_at", fetch_time()), page_fetch_times(posts)
    if comments is None:
        posts = posts.withColumn("comments_html", F.lit(None).cast("string"))
    else:
        posts = posts.join(comments_html(comments, fetch), "post_id", "left")
    fetched = F.col("fetched_at")
    flags = F.array_join(F.transform("flags", lambda f: _cat('<span class="flag flag_', attr_esc(f), '">',
                                                             esc(f), "</span>")), "")
    hubs = F.array_join(F.transform("hubs", lambda h: _cat('<a class="hub" href="', attr_esc(h["url"]), '">',
                                                           esc(h["name"]), "</a>")), ", ")
    tags = F.array_join(F.transform("tags", lambda t: _cat('<li><a href="/search/?q=', attr_esc(t), '">',
                                                           esc(t), "</a></li>")), "")
    html = _cat(
        "<!DOCTYPE html><html><head><title>", esc("title"), "</title>",
        '<link rel="canonical" href="', attr_esc("url"), '"></head><body>',
        '<div class="post shortcuts_item" id="post_', F.col("post_id").cast("string"), '">',
        '<div class="published">', FD.render_site_datetime(F.col("published"), fetched), "</div>",
        '<h1 class="title"><span class="post_title">', esc("title"), "</span>", flags, "</h1>",
        '<div class="hubs">', hubs, "</div>",
        '<div class="content html_format">', F.col("content_html"), "</div>",
        '<ul class="tags">', tags, "</ul>",
        '<div class="infopanel_wrapper">',
        '<div class="voting"><span class="js-score">', FD.render_number(F.col("voting_score")), "</span></div>",
        '<div class="views-count_post">', F.col("pageviews").cast("string"), "</div>",
        _opt(F.col("favs_count").isNotNull(), '<span class="js-favs_count">',
             F.col("favs_count").cast("string"), "</span>"),
        "</div></div>",
        _opt(F.col("author").isNotNull(), '<div class="author-info"><a href="/users/', attr_esc("author"),
             '/">', esc("author"), "</a></div>"),
        '<div id="comments"><h2 class="title">Комментарии ',
        _opt(F.col("comments_count").isNotNull(), '<span id="comments_count">',
             F.col("comments_count").cast("string"), "</span>"),
        "</h2>", F.coalesce("comments_html", F.lit("")), "</div></body></html>")
    return posts.select(F.col("post_id").alias("page_id"), "url", html.alias("html"),
                               fetched.alias("fetched_at"))


def _blog_origin(key: Column) -> Column:
    return F.concat(F.lit("https://b"), (key % 3).cast("string"), F.lit("." + FIXTURE_DOMAIN))


def _day(key: Column) -> Column:
    return F.timestamp_add("DAY", key, F.lit(EPOCH).cast("timestamp_ntz"))


def user_pages(customer: DataFrame) -> DataFrame:
    """User profile pages from ``customer`` (karma = account balance)."""
    k = F.col("c_custkey")
    login = F.concat(F.lit("c"), k.cast("string"))
    url = F.concat(_blog_origin(k), F.lit("/users/"), login, F.lit("/"))
    fetched = F.timestamp_add("HOUR", k % 48, _day(k + 30))
    last_seen = F.timestamp_add("DAY", -(k % 3), fetched)
    registered = _day(k)
    reg_text = F.concat_ws(" ", F.dayofmonth(registered).cast("string"),
                           F.element_at(F.array(*[F.lit(m) for m in FD.MONTHS_GENITIVE]), F.month(registered)),
                           F.year(registered).cast("string"))
    segment = F.col("c_mktsegment")
    html = _cat(
        '<html><head><link rel="canonical" href="', url, '"></head><body>',
        '<div class="user_header">',
        '<a class="avatar" href="/users/', login, '/"><img src="/images/avatars/', login, '.png"></a>',
        '<h2 class="username"><a href="/users/', login, '/"> ', login, " </a></h2>",
        '<div class="karma"><div class="num">', FD.render_number(F.col("c_acctbal")), "</div></div>",
        '<div class="rating"><div class="num">', FD.render_number(F.col("c_nationkey").cast("double")),
        "</div></div></div>",
        '<div class="user_profile"><div class="fullname"> ', esc("c_name"), " </div>",
        "<dl><dt>Зарегистрирован:</dt><dd>", reg_text, " по приглашению ",
        '<a href="/users/c', (k + 7).cast("string"), '/">c', (k + 7).cast("string"), "</a></dd></dl>",
        "<dl><dt>Активность:</dt><dd>Последний раз был на сайте ",
        FD.render_site_datetime(last_seen, fetched), "</dd></dl>",
        '<dl id="working_in"><dt>Работает в:</dt><dd><ul><li><a href="/company/s', (k % 10).cast("string"),
        '/">s', (k % 10).cast("string"), "</a></li></ul></dd></dl>",
        "<dl><dt>Состоит в:</dt><dd><ul>",
        '<li><a href="/hub/n', F.col("c_nationkey").cast("string"), '/">n', F.col("c_nationkey").cast("string"),
        "</a></li>",
        '<li><a href="/hub/', F.lower(segment), '/">', esc(segment), "</a></li>",
        "<li><span>no link</span></li></ul></dd></dl>",
        "<dl><dt>Интересы:</dt><dd>", '<a href="/search/?q=', attr_esc(segment), '">', esc(segment), "</a></dd></dl>",
        '<dl><dt>Сайт:</dt><dd><a href="https://', login, '.example.com/">', login, ".example.com</a></dd></dl>",
        "<dl><dt>О себе:</dt><dd><p>", esc("c_name"), " from nation ", F.col("c_nationkey").cast("string"),
        "</p></dd></dl>",
        "<dl><dt>Пригласил на сайт:</dt><dd><ul><li>",
        '<a href="/users/c', (k + 1).cast("string"), '/">c', (k + 1).cast("string"), "</a></li></ul></dd></dl>",
        "<dl><dt>Сегмент:</dt><dd>", esc(segment), "</dd></dl>",
        "<dl><dt>Сегмент:</dt><dd><b>", esc(segment), "</b></dd></dl>",
        "</div></body></html>")
    return customer.select(k.alias("page_id"), url.alias("url"), html.alias("html"), fetched.alias("fetched_at"))


def company_pages(supplier: DataFrame) -> DataFrame:
    """Company profile pages from ``supplier``."""
    k = F.col("s_suppkey")
    cid = F.concat(F.lit("s"), k.cast("string"))
    url = F.concat(_blog_origin(k), F.lit("/company/"), cid, F.lit("/profile/"))
    registered = _day(k)
    reg_text = F.concat_ws(" ", F.dayofmonth(registered).cast("string"),
                           F.element_at(F.array(*[F.lit(m) for m in FD.MONTHS_GENITIVE]), F.month(registered)),
                           F.year(registered).cast("string"))
    html = _cat(
        '<html><head><link rel="canonical" href="', url, '"></head><body>',
        '<div class="company_header"><div class="company_icon"><img src="/images/companies/', cid, '.png"></div>',
        '<div class="name"><a href="/company/', cid, '/">', esc("s_name"), "</a></div></div>",
        '<div class="company_profile">',
        "<dl><dt>О компании:</dt><dd><p>", esc("s_name"), " of nation ", F.col("s_nationkey").cast("string"),
        "</p></dd></dl>",
        '<dl><dt>Сайт:</dt><dd><a href="https://', cid, '.example.net/">', cid, ".example.net</a></dd></dl>",
        '<dl><dt>Сотрудники на сайте:</dt><dd><ul class="users">',
        '<li><a href="/users/c', k.cast("string"), '/">c', k.cast("string"), "</a></li>",
        '<li><a href="/users/c', (k + 1).cast("string"), '/">c', (k + 1).cast("string"), "</a></li>",
        "</ul></dd></dl>",
        "<dl><dt>Дата регистрации:</dt><dd>", reg_text, "</dd></dl>",
        "<dl><dt>Страна:</dt><dd>n", F.col("s_nationkey").cast("string"), "</dd></dl>",
        "<dl><dd>no label</dd></dl>",
        "</div></body></html>")
    return supplier.select(k.alias("page_id"), url.alias("url"), html.alias("html"))


def favourites_pages(comments: DataFrame, posts: DataFrame, per_page: int = 10) -> DataFrame:
    """Favourites pages: each user's commented posts, ``per_page`` post-id
    buckets per page (bounded pages, no per-user collect)."""
    pairs = (comments.where(~F.col("banned") & F.col("username").isNotNull())
             .select("username", "post_id").distinct()
             .join(posts.select("post_id", "url", "title"), "post_id"))
    anchors = pairs.groupBy("username", F.expr(f"post_id div {per_page}").alias("page_no")).agg(
        F.sort_array(F.collect_list(F.struct("post_id", "url", "title"))).alias("items"))
    items = F.array_join(F.transform("items", lambda p: _cat(
        '<div class="post"><h2><a class="post_title" href="', attr_esc(p["url"]), '">', esc(p["title"]),
        '</a></h2><a class="post_title" href="https://b0.example.org/post/999999999/">second</a></div>')), "")
    page_url = F.concat(F.lit("https://b0." + FIXTURE_DOMAIN + "/users/"), F.col("username"),
                        F.lit("/favorites/page"), F.col("page_no").cast("string"), F.lit("/"))
    html = _cat(
        '<html><body><div class="user_header"><h2 class="username"><a href="/users/', attr_esc("username"),
        '/">', esc("username"), "</a></h2></div>",
        '<div class="user_favorites">', items,
        '<div class="post"><h2><span>removed</span></h2></div>',
        "</div>",
        '<div class="side"><div class="post"><a class="post_title" href="https://b0.example.org/post/1/">beside</a></div></div>',
        '<ul id="nav-pages"><li><a href="page', (F.col("page_no") + 1).cast("string"), '/">next</a></li></ul>',
        "</body></html>")
    return anchors.select(page_url.alias("url"), html.alias("html"))
