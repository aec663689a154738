"""Links by their place in the page (J26 and side blocks, J23 favourites).

A place is a chain of descendant steps over the page's elements
(:mod:`blogweave.functions.markup`); everything is a native expression.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blogweave.functions import html as H
from blogweave.functions import markup as M
from blogweave.functions import urls as U


class Place(NamedTuple):
    """Links of one kind: steps of (tag, class, id) down to the anchors.
    ``first_of``: after so many steps, only the first anchor of each element."""
    kind: str
    steps: tuple[tuple[str, str | None, str | None], ...]
    priority: int = 0
    first_of: int | None = None


# Fixed places of the blogs' markup.
_NAV = (("ul", None, "nav-pages"), ("li", None, None), ("a", None, None))
FEED = (Place("post", (("div", "posts", None), ("div", "post", None), ("h1", "title", None), ("a", "post_title", None))),
        Place("page", (("div", "page-nav", None), *_NAV)))
SIDE = (Place("post", (("div", "post_item", None), ("a", "post_name", None))),
        Place("hub", (("ul", "categories", None), ("li", None, None), ("a", None, None))),
        Place("author", (("div", "author-info", None), ("a", None, None))),
        Place("commenter", (("div", "comment_body", None), ("a", "username", None))))
FAVOURITES = (Place("post", (("div", "user_favorites", None), ("div", "post", None), ("a", "post_title", None)), first_of=2),
              Place("page", (("ul", None, "nav-pages"), ("a", None, None)), priority=2))



def _links(of: Column, found: Column, places: tuple[Place, ...]) -> Column:
    """``ARRAY<STRUCT<kind, pos, href, priority>>`` of a page's links."""
    out = []
    for place in places:
        if place.first_of is None:
            nodes = M.path(found, *place.steps)
        else:
            boxes = M.path(found, *place.steps[:place.first_of])
            inner = boxes
            for step in place.steps[place.first_of:]:
                inner = M.inside(inner, M.pick(found, *step))
            nodes = M.first_inside(boxes, F.filter(inner, lambda e: e["tag"].rlike(H.HREF)))
        out.append(_rows(place, M.attributes(nodes, H.HREF)))
    return F.concat(*out)


def _rows(place: Place, hrefs: Column) -> Column:
    return F.transform(hrefs, lambda h, k: F.struct(F.lit(place.kind).alias("kind"), k.alias("pos"), h.alias("href"),
                                                    F.lit(place.priority).alias("priority")))


def scoped_links(pages: DataFrame, places: tuple[Place, ...]) -> DataFrame:
    """``(page_id, url, kind, pos, href, abs_url, priority, user, error)``;
    ``user`` is the name a profile page is about.  A page without html gives
    one row of kind ``error``."""
    names = tuple(sorted({tag for p in places for tag, _, _ in p.steps if tag} | {"h2"}))

    def of(o: Column, e: Column) -> Column:
        user = M.first_text(o, M.path(e, ("h2", "username", None), ("a", None, None)))
        return F.struct(user.alias("user"), _links(o, e, places).alias("links"))

    none = F.array(F.struct(F.lit("error").alias("kind"), F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("href"),
                            F.lit(None).cast("int").alias("priority")))
    page = M.staged(pages.select("page_id", "url", "html", F.col("html").isNull().alias("_none")), "_tokens", M.tokens(F.col("html"))).drop("html")
    page = M.staged(page, "_elements", M.elements(F.col("_tokens"), names))
    page = M.staged(page, "_page", M.let(F.col("_tokens"), lambda o: M.let(F.col("_elements"), lambda e: of(o, e))))
    rows = page.select("page_id", "url", F.col("_page.user").alias("user"), "_none",
                       F.inline(F.when(F.col("_none"), none).otherwise(F.col("_page.links"))))
    return rows.select("page_id", "url", "kind", "pos", "href", U.join_url("url", "href").alias("abs_url"), "priority", "user",
                       F.when(F.col("_none"), F.lit("no html")).alias("error"))
