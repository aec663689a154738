"""Which pages a crawl reaches: breadth first over stored links.

Semi-naive iteration: a round joins only the pages found in the last one with
the links, keeps one row per new page (the smallest referrer) and leaves out
what any earlier round has found.  Every round is written to the shared folder,
so plans stay short and lost executors cost their own tasks; it ends with the
round that finds nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blogweave.functions import urls as U
from blogweave.session import materialize


def reachable(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """``(url, depth, referrer)`` of every page that ``links`` (src, dst) lead
    to from ``seeds`` (url), as canonical URLs; pages are known by the key of
    their identity.  Seeds have depth 0 and no referrer, others the smallest
    one among the pages one step nearer."""
    edges, _ = materialize(links.where("src IS NOT NULL AND dst IS NOT NULL").select(
        U.identity_key("src").alias("key"), U.identity_key("dst").alias("to"), U.identity("src").alias("referrer"),
        U.identity("dst").alias("url")).distinct(), "link-graph")
    first = seeds.where("url IS NOT NULL").select(U.identity_key("url").alias("key"), U.identity("url").alias("url")).distinct()
    now, n = materialize(first.select("key", "url", F.lit(0).alias("depth"), F.lit(None).cast("string").alias("referrer")), "reached", n=F.count("*"))
    rounds = [now]
    while n["n"]:
        found = now.select("key").join(edges, "key").groupBy(F.col("to").alias("key")).agg(F.min("url").alias("url"), F.min("referrer").alias("referrer"))
        seen = reduce(DataFrame.unionByName, [r.select("key") for r in rounds])
        new = found.join(seen, "key", "left_anti").select("key", "url", F.lit(len(rounds)).alias("depth"), "referrer")
        now, n = materialize(new, "reached", n=F.count("*"))
        rounds.append(now)
    return reduce(DataFrame.unionByName, rounds).select("url", "depth", "referrer")
