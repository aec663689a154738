"""Crawl bookkeeping as table operations.

Fetch outcomes, the ids still to fetch, seed URLs, link routing and the
set of new links.  The network fetch itself is outside: input pages are
already fetched.  Anti joins are left to the planner (broadcast when the
known side is small, sort-merge otherwise; AQE decides at run time).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blogweave.functions import html as H
from blogweave.functions import urls as U
from blogweave.sources.dims import (DEFAULT_ALLOWED_DOMAINS, DEFAULT_FEED_PAGES,
                                    DEFAULT_FEED_ROOT, DEFAULT_RESTRICTED_TITLE)

# Fixed routing rules of the original crawl, in order; first match wins.
ROUTES = [
    (r"/post/(\d+)/$", "post"),
    (r"/users/(\w+)/topics/", "user_topics"),
    (r"/users/(\w+)/comments/", "user_comments"),
    (r"/users/(\w+)/favorites/", "user_favorites"),
    (r"/users/(\w+)/$", "user_profile"),
    (r"/company/(\w+)/blog/(\d+)/$", "post"),
    (r"/company/(\w+)/profile/$", "company_profile"),
    (r"/company/(\w+)/fans/all/rating/", "company_fans"),
]
FOLLOW = "follow"
DONE_OUTCOMES = ("stored", "404", "forbidden")


def _ascii(pattern: str) -> str:
    # \w and \d are ASCII in the original; spell them out for Java and RE2.
    return pattern.replace(r"\w", "[A-Za-z0-9_]").replace(r"\d", "[0-9]")


def domain_pattern(domains: list[str]) -> str:
    """Host equal to, or a subdomain of, one of ``domains``."""
    alts = "|".join(re.escape(d) for d in domains)
    return rf"(?s)^(?!\.)(?!.*\.\.)(?:.*\.)?(?:{alts})$"


def mobile_deny_pattern(domains: list[str]) -> str:
    """The original deny list: ``m.`` in front of each allowed domain."""
    return domain_pattern([f"m.{d}" for d in domains])


def extraction_outcomes(pages: DataFrame, restricted_title: str = DEFAULT_RESTRICTED_TITLE,
                        container_tag: str = "[a-z0-9]+", container_class: str | None = "post") -> DataFrame:
    """Outcome per fetched page.

    404 → ``404``; 200 with the restriction title → ``forbidden``; 200
    without html or without the container → ``exception`` with the error text (a dead
    letter, retried later); 200 otherwise → ``stored``; any other status
    leaves no outcome.  A page without a status column counts as 200.
    """
    title = H.title("html")
    restricted = F.coalesce(title.endswith(F.lit(restricted_title)), F.lit(False))
    has_container = F.coalesce(F.col("html").rlike(H.open_tag(container_tag, container_class)), F.lit(False))
    outcome = F.when(restricted, F.lit("forbidden")).when(~has_container, F.lit("exception")).otherwise(F.lit("stored"))
    if "status" in pages.columns:
        outcome = F.when(F.col("status") == 404, F.lit("404")).when(F.col("status") == 200, outcome)
    error = F.when(outcome == "exception", F.when(F.col("html").isNull(), F.lit("no html")).otherwise(F.lit("no container element")))
    return pages.select("page_id", outcome.alias("outcome"), error.alias("error"))


def pending_pages(spark: SparkSession, outcomes: DataFrame, start: int, finish: int) -> DataFrame:
    """Ids of the half-open range [start, finish) not yet stored, not
    404 and not forbidden; failed extractions are fetched again."""
    done = outcomes.where(F.col("outcome").isin(*DONE_OUTCOMES)).select(F.col("page_id").alias("id"))
    return spark.range(start, finish).join(done, "id", "left_anti").withColumnRenamed("id", "page_id")


def post_range_seeds(spark: SparkSession, min_id: int, max_id: int, base_urls: list[str]) -> DataFrame:
    """Inclusive id range × blog base URLs → ``<base>/post/<id>`` (no slash).

    Each id row expands into one row per site (a bounded literal array),
    so no join is needed.
    """
    origins = [re.match(r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", b).group(1) for b in base_urls]
    return (spark.range(min_id, max_id + 1)
            .select(F.col("id").alias("post_id"), F.explode(F.array(*[F.lit(o) for o in origins])).alias("o"))
            .select(F.concat("o", F.lit("/post/"), F.col("post_id").cast("string")).alias("url"),
                    F.lit("post").alias("kind"), "post_id"))


def feed_seeds(spark: SparkSession, base_urls: list[str], feed_pages: list[str] = DEFAULT_FEED_PAGES,
               root: str | None = DEFAULT_FEED_ROOT) -> DataFrame:
    """Feed root plus every site × feed page (bounded: sites × pages)."""
    rows = [(b.rstrip("/") + p, "feed") for b in base_urls for p in feed_pages]
    if root:
        rows.append((root, "root"))
    return spark.createDataFrame(rows, "url string, kind string").withColumn("post_id", F.lit(None).cast("bigint"))


def explicit_post_seeds(post_ids: DataFrame, base_url: str) -> DataFrame:
    """Post pages of an explicit id list on one site: ``<base>/post/<id>/``."""
    origin = re.match(r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", base_url).group(1)
    return post_ids.select(F.concat(F.lit(origin + "/post/"), F.col("post_id").cast("string"), F.lit("/")).alias("url"),
                           F.lit("post").alias("kind"), F.col("post_id").cast("bigint").alias("post_id"))


def frontier_seeds(spark: SparkSession, min_id: int, max_id: int, base_urls: list[str],
                   feed_pages: list[str] = DEFAULT_FEED_PAGES, root: str | None = DEFAULT_FEED_ROOT,
                   post_ids: DataFrame | None = None) -> DataFrame:
    """Union of the id-range seeds, the feed seeds and, optionally,
    explicit post ids on the first site."""
    out = post_range_seeds(spark, min_id, max_id, base_urls).unionByName(
        feed_seeds(spark, base_urls, feed_pages, root))
    return out.unionByName(explicit_post_seeds(post_ids, base_urls[0])) if post_ids is not None else out


def route_links(links: DataFrame, allowed_domains: list[str] = DEFAULT_ALLOWED_DOMAINS,
                deny_host_pattern: str | None = None, url_col: str = "abs_url") -> DataFrame:
    """First matching routing rule per link.

    A denied host skips the eight specific rules and falls to ``follow``;
    a host outside the allowed domains is off-site (not requested).
    """
    deny = deny_host_pattern or mobile_deny_pattern(allowed_domains)
    url = F.col(url_col)
    host = F.lower(F.regexp_replace(U.netloc(url), r":[0-9]*$", ""))
    denied = F.coalesce(host.rlike(deny), F.lit(False))
    route = F.lit(FOLLOW)
    for pattern, name in reversed(ROUTES):
        route = F.when(~denied & url.rlike(_ascii(pattern)), F.lit(name)).otherwise(route)
    return links.select("*", host.alias("host"), denied.alias("denied"), route.alias("route"),
                        F.coalesce(host.rlike(domain_pattern(allowed_domains)), F.lit(False)).alias("on_site"))


def new_links(routed: DataFrame, known: DataFrame, url_col: str = "abs_url") -> DataFrame:
    """On-site links to fetch, one per URL identity, that are not known yet:
    ``(url, route)``, of equal identities the smallest URL.  Only 128-bit
    keys, one URL each, are shuffled, summed up before."""
    seen = known.select(U.identity_key("url").alias("_key")).distinct()
    found = (routed.where("on_site").select(U.identity_key(url_col).alias("_key"), F.col(url_col).alias("url"), "route")
             .groupBy("_key").agg(F.min("url").alias("url"), F.min_by("route", "url").alias("route")))
    return found.join(seen, "_key", "left_anti").select("url", "route")


def link_identities(links: DataFrame, known: DataFrame, url_col: str = "abs_url") -> DataFrame:
    """Canonical forms not known yet: ``(identity, url, n_links)`` with the
    smallest URL and the number of links of that identity."""
    seen = known.select(U.identity_key("url").alias("_key")).distinct()
    found = (links.select(F.col(url_col).alias("url")).where("url IS NOT NULL").withColumn("_key", U.identity_key("url"))
             .groupBy("_key").agg(F.min("url").alias("url"), F.count("*").alias("n_links")))
    return found.join(seen, "_key", "left_anti").select(U.identity("url").alias("identity"), "url", "n_links")
