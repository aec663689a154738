"""Favourite edges (user → post key) from favourites pages.

Each favourite's first post link is taken, inside the page's list of
favourites only.  Post keys are ``<blog>/<post id>``; links whose host is
unknown or whose URL has no post id go to the dead letters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blogweave.functions import urls as U
from blogweave.operators.scoped_links import FAVOURITES, scoped_links


def _posts(pages: DataFrame, sites: DataFrame) -> DataFrame:
    links = scoped_links(_with_id(pages), FAVOURITES).where("kind = 'post'")
    return U.with_url_ids(links.select("user", F.col("abs_url").alias("post_url")), sites, "post_url")


def _with_id(pages: DataFrame) -> DataFrame:
    return pages if "page_id" in pages.columns else pages.withColumn("page_id", F.lit(None).cast("bigint"))


def favourite_edges(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """Distinct ``(user, post_key)`` edges."""
    ids = _posts(pages, sites)
    return (ids.where(F.col("post_id").isNotNull() & F.col("blog_id").isNotNull() & F.col("user").isNotNull())
            .select("user", F.concat("blog_id", F.lit("/"), F.col("post_id").cast("string")).alias("post_key"))
            .distinct())


def favourite_pages(pages: DataFrame) -> DataFrame:
    """Further favourites pages to fetch: ``(url, next_url, priority)``."""
    return scoped_links(_with_id(pages), FAVOURITES).where("kind = 'page'").select("url", F.col("abs_url").alias("next_url"), "priority")


def favourite_dead_letters(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """Links that give no edge, and pages that could not be read (their URL as ``post_url``)."""
    ids = _posts(pages, sites)
    lost = ids.where(F.col("post_id").isNull() | F.col("blog_id").isNull() | F.col("user").isNull()).select(
        "user", "post_url",
        F.when(F.col("blog_id").isNull(), F.lit("unknown host")).when(F.col("post_id").isNull(), F.lit("no post id"))
        .otherwise(F.lit("no user")).alias("error"))
    unread = pages.where(F.col("html").isNull()).select(F.lit(None).cast("string").alias("user"), F.col("url").alias("post_url"), F.lit("no html").alias("error"))
    return lost.unionByName(unread)
