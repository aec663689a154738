"""The driver's pages with the blogs' markup added.

The driver's ``pages`` are plain web pages without posts, feeds or canonical
links.  Here every page gets a block of site markup, which depends on its id so
that each rule, kind, outcome and quoting occurs; ``plans/oracle.py`` builds the
same text in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blogweave.sources.dims import DEFAULT_RESTRICTED_TITLE


def _block(n: Column, url: Column) -> Column:
    """Site markup of page ``n``."""
    def text(template: str) -> Column:
        out = F.lit(template)
        return F.replace(F.replace(out, F.lit("{n}"), n.cast("string")), F.lit("{m}"), (n + 1).cast("string"))

    post = (F.when(n % 6 == 2, F.lit('<div class="posts-none">'))
            .when(n % 3 == 0, text('<div class="post shortcuts_item" id="post_{n}">'))
            .when(n % 3 == 1, text("<div id='post_{n}' class='x post'>"))
            .otherwise(text("<div class=post id=post_{n}>")))
    stray = F.when(n % 4 == 1, F.lit('<link rel="canonical" href="https://b0.example.org/post/1/">')).otherwise(F.lit(""))
    escaped = F.replace(url, F.lit("&"), F.lit("&amp;"))
    return F.concat(
        stray, post, F.lit("<p>body</p></div>"),
        F.when(n % 6 == 2, F.lit('<div class="posts"><div class="item">')).otherwise(F.lit("<div class=\"posts\"><div class='item post'>")),
        text('<h1 class=title><a class="post_title" href="/post/{n}/">one</a></h1>'
             '<a class="post_title" href="/aside/{n}/">aside</a></div></div>'
             '<div class="page-nav"><ul id="nav-pages"><li><a href="page{m}/">next</a></li>'
             "<li><ul><li><a href='?page=2&amp;x=1'>more</a></li></ul></li></ul></div>"
             '<div class=post_item><a class="post_name" href="https://b1.example.org/company/co{n}/blog/{n}/">side</a></div>'
             '<ul class="categories"><li><a class=hub href=/hub/h{n}/>hub</a></li></ul>'
             '<div class="author-info"><a href="/users/author{n}/">author</a></div>'
             '<div class="comment_body "><a class="username big" href="/users/user{n}/">user</a></div>'
             '<a data-href="/wrong/" title="a > b" href="/users/user{n}/topics/">topics <b>bold</b></a>'
             '<a href="/users/user{n}/comments/">open<a href="/users/user{n}/favorites/">favourites</a>'
             '<a href="https://b2.example.org/company/co{n}/profile/">profile</a>'
             '<a href="https://b2.example.org/company/co{n}/fans/all/rating/">fans</a>'
             '<a href="https://m.example.org/post/{n}/">mobile</a><a href="//other.test/post/{n}/">off site</a>'
             '<a href="https://b1.example.org/post/{n}/">post</a><a name="no-href">none</a>'
             '<a href="https://b1.example.org/users/user{n}/">profile</a>'),
        F.lit('<a href="'), escaped, F.lit('">self</a>'))


def site_pages(pages: DataFrame) -> DataFrame:
    """``(page_id, url, html, status)`` with the added markup."""
    n, html = F.col("page_id"), F.col("html")

    def head(link: str) -> Column:
        return F.replace(html, F.lit("</head>"), F.concat(F.replace(F.replace(F.lit(link), F.lit("{n}"), n.cast("string")),
                                                                    F.lit("{k}"), (n % 3).cast("string")), F.lit("</head>")))

    html = (F.when(n % 8 == 0, head('<link rel="canonical" href="https://b{k}.example.org/company/co{n}/blog/{n}/"></link>'))
            .when(n % 8 == 4, head('<link rel=canonical href=https://b{k}.example.org/hub/h{n}/>'))
            .when(n % 4 == 2, head("<link href='https://b1.example.org/users/u{n}/' rel='canonical'>")).otherwise(html))
    html = (F.when(n % 6 == 1, F.replace(html, F.lit("</title>"), F.lit(" " + DEFAULT_RESTRICTED_TITLE + "</title>")))
            .when(n % 6 == 3, F.replace(html, F.lit("title>"), F.lit("h6>"))).otherwise(html))
    status = F.when(n % 10 == 3, 404).when(n % 10 == 7, 500).otherwise(200)
    return pages.select("page_id", "url", F.concat(html, _block(n, F.col("url"))).alias("html"), status.alias("status"))


# Ways to write one address; the SQL side knows that they are the same by construction.
VARIANTS = ("https://b1.example.org/~u{n}/p%D0%BE/?a=1&b={n}", "https://b1.example.org/%7Eu{n}/p%d0%be/?a=1&b={n}#comments",
            "HTTPS://B1.Example.ORG:443/~%75{n}/p%D0%BE/?b={n}&a=1", "https://b1.example.org/~u{n}/p%D0%BE/?b={n}&&a=%31#")


def link_variants(pages: DataFrame) -> DataFrame:
    """``(page_id, abs_url)``: every page links to one address in four ways, and to another one (a different query)."""
    n = F.col("page_id").cast("string")
    urls = [F.replace(F.lit(v), F.lit("{n}"), n) for v in (*VARIANTS, "https://b1.example.org/~u{n}/p%D0%BE/?a=1&a=1&b={n}")]
    return pages.select("page_id", F.explode(F.array(*urls)).alias("abs_url"))


def known_variants(pages: DataFrame) -> DataFrame:
    """``(url,)``: every third page's address is known, in its third way to write it."""
    return pages.where("page_id % 3 = 0").select(F.replace(F.lit(VARIANTS[2]), F.lit("{n}"), F.col("page_id").cast("string")).alias("url"))


def page_graph(pages: DataFrame) -> DataFrame:
    """``(src, dst)``: links between the given pages, with cycles, a hub and pages that nothing leads to."""
    n = F.col("page_id")
    to = F.explode(F.array(2 * n + 1, 3 * n + 7, F.expr("page_id div 2"), F.lit(0).cast("long"))).alias("to")
    aims = pages.select(n.alias("to"), F.col("url").alias("dst"))
    return pages.select(F.col("url").alias("src"), n, to).where("page_id % 5 <> 4").join(aims, "to").select("src", "dst")
