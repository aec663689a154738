"""Extraction of posts and comments from pages.

Everything is a native expression over the page's tokens and elements
(:mod:`blogweave.functions.markup`): no Python worker, no shuffle, one pass per
page.  A comment's place follows from the depth of its element; its fields are
read from its own body only, in a row of its own.  Every conversion — dates,
numbers, ids from URLs, host → blog lookup — is a native expression on the
result.

Every page ends in exactly one of the records and the dead letters: pages
without a post, without a usable id or on an unknown host are told apart by
``error``.  Markup is kept as written.

Selectors (the markup spec of the blogs, data rather than logic): post
container ``.post``, id attribute ``post_<n>``, title ``h1.title
span.post_title``, ``div.published``, flags ``h1.title .flag``, hubs
``.hubs a.hub``, ``div.content``, tags ``ul.tags li a``, views
``div.views-count_post``, favourites ``span.js-favs_count``, score
``span.js-score``, author anchors in ``div.post-type`` / ``div.author-info``,
``#comments`` with ``h2.title span#comments_count``; comment items, bodies
and reply containers match their exact class strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blogweave.functions import fields as FD
from blogweave.functions import html as H
from blogweave.functions import markup as M
from blogweave.functions import urls as U

# Fixed markup values of the blogs.
COMMENT_ITEM_CLASS = "comment_item"
COMMENT_BODY_CLASS = "comment_body "       # with the trailing space
REPLIES_CLASS = "reply_comments"


def _paths(items: Column) -> Column:
    """``ARRAY<STRUCT<k, anc, path>>`` of items (i, rel) in document order: an
    item's parent is the last one before it that is a level up, its number that
    among its parent's items, and paths are put together by pointer doubling."""
    def level(x: Column) -> Column:
        return ((x["rel"] - 1) / 2).cast("int")

    def of(v: Column) -> Column:
        pairs = F.sort_array(F.concat(
            F.transform(v, lambda x, k: F.struct(level(x).alias("lvl"), x["i"].alias("i"), F.lit(1).alias("role"), (k + 1).alias("k"))),
            F.transform(v, lambda x, k: F.struct((level(x) + 1).alias("lvl"), x["i"].alias("i"), F.lit(0).alias("role"), (k + 1).alias("k")))))

        def linked(m: Column, last: Column) -> Column:
            def child(x: Column, k: Column) -> Column:
                above = F.get(m, F.get(last, k) - 1)
                return F.struct(F.when(above["lvl"] == x["lvl"], above["k"]).otherwise(F.lit(0)).alias("parent"), x["i"].alias("i"),
                                x["k"].alias("k"), x["role"].alias("role"))
            return F.sort_array(F.filter(F.transform(m, child), lambda x: x["role"] == 1))

        def numbered(c: Column, first: Column) -> Column:
            return F.sort_array(F.transform(c, lambda x, k: F.struct(x["k"].alias("k"), x["parent"].alias("anc"),
                                                                     F.array(k - F.get(first, k)).alias("path"))))

        def doubled(acc: Column, _: Column) -> Column:
            def one(x: Column) -> Column:
                up = F.get(acc, x["anc"] - 1)
                return F.when(x["anc"] == 0, x).otherwise(F.struct(x["k"].alias("k"), up["anc"].alias("anc"), F.concat(up["path"], x["path"]).alias("path")))
            return F.transform(acc, one)

        children = M.let(pairs, lambda m: M.let(M.running_max(F.transform(m, lambda x, k: F.when(x["role"] == 0, k + 1).otherwise(F.lit(0)))),
                                                lambda last: linked(m, last)))
        nodes = M.let(children, lambda c: M.let(M.running_max(F.transform(c, lambda x, k: F.when(
            (k > 0) & (F.get(c, k - 1)["parent"] != x["parent"]), k).otherwise(F.lit(0)))), lambda first: numbered(c, first)))
        deepest = F.coalesce(F.array_max(F.transform(v, level)), F.lit(0))
        return M.let(deepest, lambda d: F.aggregate(M.powers(lambda p: p <= d), nodes, doubled))
    return of(items)


def comment_bodies(of: Column, found: Column) -> Column:
    """``ARRAY<STRUCT<path, body>>``: each comment's place and the tokens of its body.

    Within ``#comments``, items are at odd depths of ``div`` and their bodies and
    reply containers at even ones.  What stands within another ``div``, or in an
    item without a body, is no comment and takes no place; the items of all
    containers of one level (several ``#comments``, or several reply
    containers of one comment) are numbered as one list."""
    def span(x: Column) -> Column:
        return F.struct(x["i"].alias("i"), x["end"].alias("end"))

    def placed(divs: Column, root: Column) -> Column:
        def one(x: Column, k: Column) -> Column:
            r = F.get(divs, F.get(root, k) - 1)
            return F.struct(x["i"].alias("i"), x["end"].alias("end"), (x["level"] - r["level"]).alias("rel"), x["cls"].alias("cls"),
                            F.coalesce(r["end"] > x["i"], F.lit(False)).alias("ok"))
        return F.filter(F.transform(divs, one), lambda x: x["ok"] & (x["rel"] > 0))

    def comments(p: Column) -> Column:
        odd = lambda x: x["rel"] % 2 == 1       # noqa: E731
        items = F.filter(p, lambda x: odd(x) & (x["cls"] == COMMENT_ITEM_CLASS))
        bodies = F.filter(p, lambda x: ~odd(x) & (x["cls"] == COMMENT_BODY_CLASS))
        other = F.filter(p, lambda x: F.when(odd(x), x["cls"] != COMMENT_ITEM_CLASS).otherwise(x["cls"] != REPLIES_CLASS))
        return M.let(items, lambda it: M.let(bodies, lambda b: with_bodies(it, b, other)))

    def with_bodies(it: Column, b: Column, other: Column) -> Column:
        merged = F.sort_array(F.concat(
            F.transform(it, lambda x, k: F.struct((x["rel"] + 1).alias("lvl"), x["i"].alias("i"), F.lit(0).alias("role"), x["end"].alias("end"), k.alias("k"))),
            F.transform(b, lambda x, k: F.struct(x["rel"].alias("lvl"), x["i"].alias("i"), F.lit(1).alias("role"), x["end"].alias("end"), k.alias("k")))))

        def owned(m: Column) -> Column:
            def one(x: Column, k: Column) -> Column:
                y = F.get(m, k + 1)
                own = (y["role"] == 1) & (y["lvl"] == x["lvl"]) & (y["i"] < x["end"])
                return F.struct(x["i"].alias("i"), x["end"].alias("end"), (x["lvl"] - 1).alias("rel"), x["role"].alias("role"),
                                F.when(own, y["i"]).alias("body_i"), F.when(own, y["end"]).alias("body_end"))
            return F.filter(F.transform(m, one), lambda x: x["role"] == 0)

        def valid(w: Column) -> Column:
            dead = F.concat(F.transform(other, span), F.transform(F.filter(w, lambda x: x["body_i"].isNull()), span))
            return M.inside(dead, F.filter(w, lambda x: x["body_i"].isNotNull()), outside=True)

        def rows(v: Column) -> Column:
            def one(n: Column) -> Column:
                x = F.get(v, n["k"] - 1)
                return F.struct(n["path"].alias("path"), M.part(of, x["body_i"] + 1, x["body_end"] - 1).alias("body"))
            return F.transform(_paths(v), one)
        return M.let(M.let(merged, owned), lambda w: M.let(valid(w), rows))

    roots = lambda d: M.running_max(F.transform(d, lambda x, k: F.when(F.coalesce(x["id"] == "comments", F.lit(False)), k + 1).otherwise(F.lit(0))))
    return M.let(F.filter(found, lambda x: x["name"] == "div"), lambda d: M.let(roots(d), lambda r: M.let(placed(d, r), comments)))


def comment_fields(o: Column, e: Column) -> Column:
    """The raw fields of a comment from its body's tokens and elements; those of a banned one are null."""
    banned = F.size(M.pick(e, "div", "author_banned")) > 0
    users = M.pick(e, "a", "username")
    message = F.get(M.pick(e, "div", "message"), F.lit(0))
    values = {"time_text": M.first_text(o, M.pick(e, "time")), "username": M.first_text(o, users),
              "user_url": M.first_attribute(users, H.HREF), "link": M.first_attribute(M.pick(e, "a", "link_to_comment"), H.HREF),
              "votes_text": M.first_text(o, M.path(e, ("div", "voting", None), ("span", "score", None))),
              "message_html": F.when(message.isNotNull(), M.inner_html(o, message))}
    return F.struct(banned.alias("banned"), *[F.when(~banned, v).alias(k) for k, v in values.items()])


def _commenter(c: Column) -> Column:
    """The name of a comment's author; null for a banned one."""
    def name(o: Column, e: Column) -> Column:
        return F.when(F.size(M.pick(e, "div", "author_banned")) == 0, M.first_text(o, M.pick(e, "a", "username")))
    return M.let(M.elements(c["body"], ("div", "a")), lambda e: name(c["body"], e))


def post_fields() -> Column:
    """A page's raw post fields (``found`` false when there is no ``.post``) from the columns of ``_parsed``."""
    def fields(o: Column, e: Column, posts: Column, p: Column) -> Column:
        def text(tag: str | None, cls: str, within: Column = p) -> Column:
            return M.first_text(o, M.pick(within, tag, cls))

        h1, panel = M.pick(p, "h1", "title"), F.slice(M.pick(p, "div", "infopanel"), 1, 1)
        hubs = M.path(p, (None, "hubs", None), ("a", "hub", None))
        in_panel = M.inside(panel, p)                    # older markup: counters and author live in an info panel
        old_author = M.path(in_panel, ("div", "author", None), ("a", None, None))
        content = F.get(M.pick(p, "div", "content"), F.lit(0))
        anchors = M.inside(F.concat(M.pick(e, "div", "post-type"), M.pick(e, "div", "author-info")), M.pick(e, "a"))
        counter = M.path(e, (None, None, "comments"), ("h2", "title", None), ("span", None, "comments_count"))
        return F.struct(
            (F.size(posts) > 0).alias("found"),
            F.get(F.filter(F.transform(posts, lambda x: x["id"]), lambda x: x.isNotNull()), F.lit(0)).alias("id_attr"),
            M.first_text(o, M.inside(h1, M.pick(p, "span", "post_title"))).alias("title"),
            text("div", "published").alias("published_text"),
            F.transform(M.inside(h1, M.pick(p, None, "flag")), lambda x: x["cls"]).alias("flag_classes"),
            F.transform(hubs, lambda x: H.attribute(x["tag"], H.HREF)).alias("hub_hrefs"),
            F.when(content.isNotNull(), M.inner_html(o, content)).alias("content_html"),
            M.all_texts(o, M.path(p, ("ul", "tags", None), ("li", None, None), ("a", None, None))).alias("tags"),
            F.coalesce(text("div", "views-count_post"), text("div", "pageviews", in_panel)).alias("views_text"),
            F.coalesce(text("span", "js-favs_count"), text("div", "favs_count", in_panel)).alias("favs_text"),
            text("span", "js-score").alias("score_text"),
            F.sort_array(F.array_distinct(M.attributes(anchors, H.HREF))).alias("author_hrefs"),
            M.first_text(o, old_author).alias("author_name"),
            M.first_attribute(old_author, H.HREF).alias("author_href"),
            M.first_text(o, M.path(in_panel, ("div", "author", None), ("span", "rating", None))).alias("rating_text"),
            # the older markup stored the content element itself
            F.when(content.isNotNull() & (F.size(panel) > 0), M.outer_html(o, content)).alias("content_outer"),
            M.first_text(o, counter).alias("comments_count_text"))

    return M.let(F.col("_tokens"), lambda o: M.let(F.col("_elements"), lambda e: M.let(F.col("_posts"), lambda posts: M.let(
        F.col("_within"), lambda p: fields(o, e, posts, p)))))


def _page_columns(pages: DataFrame) -> DataFrame:
    fetched = F.col("fetched_at") if "fetched_at" in pages.columns else F.lit(None)
    return pages.select("page_id", "url", fetched.cast("timestamp_ntz").alias("fetched_at"), "html")


def _parsed(pages: DataFrame, *columns) -> DataFrame:
    """The pages with ``_tokens``, ``_elements``, ``_posts`` (the post containers)
    and ``_within`` (the elements in them)."""
    page = _page_columns(pages)
    page = M.staged(page.select("page_id", "url", "fetched_at", "html", *columns), "_tokens", M.tokens(F.col("html"))).drop("html")
    page = M.staged(page, "_elements", M.elements(F.col("_tokens"), ("div", "a", "li"), marked_too=True))
    page = M.staged(page, "_posts", M.pick(F.col("_elements"), None, "post"))
    return M.staged(page, "_within", M.inside(F.col("_posts"), F.col("_elements")))


def _bodies(page: DataFrame) -> DataFrame:
    return M.staged(page, "_comments", M.let(F.col("_tokens"), lambda o: M.let(F.col("_elements"), lambda e: comment_bodies(o, e))))


def extract_post_pages(pages: DataFrame, participants: bool = False) -> DataFrame:
    """Raw post fields, a row per page (``found`` false when there is no
    ``.post``); ``participants`` adds the names of commenters not banned."""
    page = _parsed(pages, U.canonical_href("html").alias("canonical"))
    if participants:
        page = M.staged(_bodies(page), "commenters", F.transform("_comments", _commenter))
    else:
        page = page.withColumn("commenters", F.array().cast("array<string>"))
    return M.staged(page, "_post", post_fields()).select("page_id", "url", "fetched_at", "canonical", "commenters", "_post.*")


def extract_comment_pages(pages: DataFrame) -> DataFrame:
    """Raw comments, a row per comment; a page without a post has none."""
    page = M.staged(_page_columns(pages), "_tokens", M.tokens(F.col("html"))).drop("html")
    # only the first post container's id is asked for, so the posts' spans are not needed
    page = M.staged(page, "_posts", F.filter("_tokens", lambda t: t.rlike(H.open_tag("[a-z][^\\s<>]*", "post")))).where(F.size("_posts") > 0)
    page = _bodies(M.staged(page, "_elements", M.elements(F.col("_tokens"), ("div",))))
    ids = F.filter(F.transform("_posts", lambda t: M.attribute_of(t, "id")), lambda x: x != "")
    rows = page.select("page_id", "fetched_at", F.get(ids, F.lit(0)).alias("id_attr"), F.inline("_comments").alias("path", "body"))
    rows = M.staged(rows, "_elements", M.elements(F.col("body"), ("div", "a", "span", "time")))
    rows = M.staged(rows, "_f", M.let(F.col("body"), lambda o: M.let(F.col("_elements"), lambda e: comment_fields(o, e))))
    return rows.select("page_id", "id_attr", "fetched_at", "path", "_f.*")


def _post_id():
    return F.regexp_extract("id_attr", "^post_([0-9]+)$", 1).try_cast("bigint")


def _strip_slashes(c):
    return F.regexp_replace(c, "^/+|/+$", "")


def typed_posts(raw: DataFrame, sites: DataFrame) -> DataFrame:
    """A typed row per page, with ``error`` null for a whole post record."""
    hub_ids = F.filter(F.transform("hub_hrefs", lambda h: U.hub_id(h)), lambda x: x.isNotNull())
    companies = F.filter(F.transform("hub_hrefs", lambda h: U.company_id(h)), lambda x: x.isNotNull())
    user_href = F.filter("author_hrefs", lambda h: h.startswith("/users/"))
    company_href = F.filter("author_hrefs", lambda h: h.startswith("/company/"))

    def author(hrefs, prefix: str):
        # Two anchors of one kind: the greatest wins (deterministic).
        return _strip_slashes(F.array_max(F.transform(hrefs, lambda h: F.regexp_replace(h, f"^/{prefix}/", ""))))

    typed = raw.select(
        "page_id",
        F.coalesce("canonical", "url").alias("url"),
        F.coalesce("found", F.lit(False)).alias("_found"), F.col("id_attr").alias("_id_attr"),
        _post_id().alias("_pid"),
        "title",
        FD.parse_site_datetime(F.col("published_text"), F.col("fetched_at")).alias("published"),
        F.transform(F.filter(F.split(F.array_join("flag_classes", " "), " "), lambda c: c.startswith("flag_")),
                    lambda c: F.regexp_replace(c, "^flag_", "")).alias("flags"),
        hub_ids.alias("hub_ids"),
        F.when(F.size(companies) > 0, F.element_at(companies, -1)).alias("company_blog"),
        "content_html", "tags",
        FD.parse_int("views_text").alias("pageviews"),
        FD.parse_int("favs_text").alias("favs_count"),
        FD.parse_int("score_text").alias("voting_score"),
        author(user_href, "users").alias("author_user"),
        author(company_href, "company").alias("author_company"),
        FD.parse_int("comments_count_text").alias("comments_count"),
        F.col("author_name").alias("author"),
        F.col("author_href").alias("author_url"),
        FD.parse_number("rating_text").alias("author_rating"),
        F.col("content_outer").alias("content_outer_html"),
        F.col("fetched_at").alias("updated_at"),
        F.col("commenters").alias("_commenters"),
    )
    # The author and every commenter not banned, each once.
    everyone = F.concat(F.array("author_user"), F.coalesce("_commenters", F.array().cast("array<string>")))
    error = (F.when(~F.col("_found"), F.lit("no post container"))
             .when(F.col("_id_attr").isNull(), F.lit("no post id"))
             .when(F.col("_pid").isNull(), F.lit("bad post id"))
             .when(F.col("blog_id").isNull(), F.lit("unknown host")))
    return U.with_url_ids(typed, sites, "url").select(
        F.lit("posts").alias("_type"),
        F.concat("blog_id", F.lit("/"), F.col("_pid").cast("string")).alias("_id"),
        "blog_id", F.col("_pid").alias("post_id"), "page_id", "url", "title", "published", "flags",
        "hub_ids", "company_blog", "content_html", "tags", "pageviews", "favs_count",
        "voting_score", "author_user", "author_company", "comments_count",
        "author", "author_url", "author_rating", "content_outer_html", "updated_at",
        F.array_sort(F.array_distinct(F.array_compact(everyone))).alias("users_participated"), error.alias("error"))


def posts_from_pages(raw: DataFrame, sites: DataFrame) -> DataFrame:
    """Typed post records; all other pages are in :func:`post_dead_letters`."""
    return typed_posts(raw, sites).where(F.col("error").isNull()).drop("error")


def post_dead_letters(raw: DataFrame, sites: DataFrame) -> DataFrame:
    """The pages that give no record, with the reason."""
    return typed_posts(raw, sites).where(F.col("error").isNotNull()).select("page_id", "url", "error")


def comments_from_pages(raw: DataFrame) -> DataFrame:
    """Flat typed comments ``(page_id, post_id, path, depth, …)`` of post pages."""
    return raw.select(
        "page_id", _post_id().alias("post_id"), "path",
        (F.size("path") - 1).alias("depth"),
        F.slice("path", 1, F.size("path") - 1).alias("parent_path"),
        "banned",
        FD.parse_site_datetime(F.col("time_text"), F.col("fetched_at")).alias("time"),
        "username", "user_url", "link",
        FD.parse_int("votes_text").alias("votes"),
        "message_html")
