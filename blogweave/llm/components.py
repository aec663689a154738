"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import kept


def stars(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b) that is not the
    smallest of its component, which is the root.  Each round hangs neighbours
    on smaller nodes; it ends when stars are left.  A round has no more rows
    than the one before and is written to the shared folder once, as each
    write is a file per partition.  Neighbours are never gathered: a hub is
    only aggregated and joined."""
    now = kept(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b"), "components")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both).filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        linked = _with_least(large)
        small = (linked.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(large.groupBy("a").agg(F.min("b").alias("b"))).distinct())
        now = kept(small, "components")
        # stars: no root hangs on another node, and no node on two roots
        ends = now.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            now.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not ends.filter("up > 1 OR up = 1 AND down = 1").limit(1).count():
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _with_least(edges: DataFrame) -> DataFrame:
    """The edges (a, b) with the smallest b of each a, m.  Both sides are dealt
    out for the join alone (by a hash and a, not by a as the sums are), so that
    a hub's rows in it can be split over tasks."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumn("h", F.xxhash64("a"))
    return edges.withColumn("h", F.xxhash64("a")).join(least, ["h", "a"]).select("a", "b", "m")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the
    component's smallest node."""
    hung = stars(edges)
    return hung.unionByName(hung.select(F.col("root").alias("node"), "root").distinct())


def joined(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """The stars (node, root) after further edges (a, b); ``roots`` is (of, root)
    of the stars so far."""
    def root_of(df: DataFrame, column: str) -> DataFrame:
        return (df.join(roots.select(F.col("of").alias(column), F.col("root").alias("_root")), column, "left")
                .withColumn(column, F.coalesce("_root", column)).drop("_root"))

    merged = stars(root_of(root_of(edges, "a"), "b"))
    old = roots.join(merged.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    # what hangs now was a root or alone before, so it is not among the old ones
    return old.select(F.col("of").alias("node"), F.coalesce("top", "root").alias("root")).unionByName(merged)
