"""Static dimension tables: blog sites, feed pages, host lists.

They are tiny and bounded by the number of sites (not by the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the original crawl (hosts, blog ids, feeds), kept as data.
DEFAULT_SITES = [
    # (host, blog_id, base_url)
    ("habrahabr.ru", "habrahabr", "http://habrahabr.ru/"),
    ("megamozg.ru", "megamozg", "http://megamozg.ru/"),
    ("geektimes.ru", "geektimes", "http://geektimes.ru/"),
]
DEFAULT_FEED_PAGES = ["/interesting/", "/all/", "/top/"]
DEFAULT_FEED_ROOT = "http://tmfeed.ru/"
DEFAULT_ALLOWED_DOMAINS = ["habrahabr.ru", "megamozg.ru", "geektimes.ru", "tmfeed.ru"]
DEFAULT_RESTRICTED_TITLE = "Доступ к странице ограничен"

# Sites of the adapter views over the driver tables: blog ``b<k>`` lives
# on host ``b<k>.example.org``.
FIXTURE_BLOG_COUNT = 3
FIXTURE_DOMAIN = "example.org"


def fixture_sites() -> list[tuple[str, str, str]]:
    out = []
    for k in range(FIXTURE_BLOG_COUNT):
        host = f"b{k}.{FIXTURE_DOMAIN}"
        out.append((host, f"b{k}", f"https://{host}/"))
    return out


def sites_frame(spark: SparkSession, sites: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """``(host, blog_id, base_url)``, a row per site.  Written as literals, the
    planner knows its size and needs no shuffle of what it is joined with."""
    rows = sites if sites is not None else fixture_sites()
    names = ("host", "blog_id", "base_url")
    return spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rows])))
