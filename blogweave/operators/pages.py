"""Page-level jobs on the raw ``pages`` table.

One scan of ``pages``, native expressions per row, and ``posexplode`` for
links: no shuffle anywhere, so the work is split exactly like the input
files.  Only ``url_ids`` joins, with the site dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blogweave.functions import html as H
from blogweave.functions import urls as U
from blogweave.sources.dims import DEFAULT_RESTRICTED_TITLE

# Anchor classes of the original markup and the link kind they stand for.
LINK_KINDS = [
    ("post_title", "post"),
    ("post_name", "post"),
    ("hub", "hub"),
    ("username", "user"),
]


def visible_text(pages: DataFrame, keep_comments: bool = True) -> DataFrame:
    """Page → its text nodes joined with no separator."""
    text = H.visible_text("html", keep_comments)
    return pages.select("page_id", text.alias("text")).withColumn("n_chars", F.length("text"))


def usable_pages(pages: DataFrame, restricted_title: str = DEFAULT_RESTRICTED_TITLE,
                 container_tag: str = "[a-z0-9]+", container_class: str | None = "post") -> DataFrame:
    """Drop pages whose title ends with the restriction phrase (a
    missing title keeps the page) and pages without a container element."""
    title = H.title("html")
    restricted = F.coalesce(title.endswith(F.lit(restricted_title)), F.lit(False))
    has_container = F.col("html").rlike(H.open_tag(container_tag, container_class))
    return (pages.where(~restricted & has_container)
            .select("page_id", "url", title.alias("title")))


def extract_links(pages: DataFrame) -> DataFrame:
    """Every anchor of every page, with its kind and absolute URL."""
    exploded = pages.select("page_id", "url", F.posexplode(H.anchors("html")).alias("pos", "a"))
    cls = H.class_of(F.col("a.tag"))
    kind = F.lit("link")
    for name, k in reversed(LINK_KINDS):
        kind = F.when(H.has_class(cls, name), F.lit(k)).otherwise(kind)
    return exploded.select(
        "page_id", "pos", kind.alias("kind"),
        F.col("a.href").alias("href"),
        U.join_url(F.col("url"), F.col("a.href")).alias("abs_url"),
        F.regexp_replace(F.col("a.inner"), H.ANY_TAG, "").alias("anchor_text"),
    )


def url_ids(pages: DataFrame, sites: DataFrame, loose: bool = False) -> DataFrame:
    """Ids carried by each page URL (canonical link preferred)."""
    base = pages.select("page_id", "url", "html")
    return (U.with_url_ids(base, sites, "url", html_col="html", loose=loose)
            .select("page_id", "canonical_url", "host", "blog_id", "host_known",
                    "company_id", "post_id", "user_id", "hub_id"))
