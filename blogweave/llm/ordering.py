"""Places and prefix sums over a whole table in a given order, without a task
that sees more than a partition or a block of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import kept

_IN_PARTITION = (1 << 33) - 1


def numbered(df: DataFrame, *order: Column, column: str = "place", name: str = "numbered") -> DataFrame:
    """``df``, written to the shared folder, with each row's place (long, from
    0) in ``order``: range partitions are sorted, and a partition's first place
    is the number of rows of those before it.  What is broadcast has a row per
    partition.  ``order`` should tell rows apart; equal rows share a partition."""
    placed = kept(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    return (placed.join(F.broadcast(first), "_part")
            .withColumn(column, F.col("_first") + F.col("_at").bitwiseAND(F.lit(_IN_PARTITION))).drop("_part", "_at", "_first"))


def running_sums(df: DataFrame, at: str, sums: dict[str, str], by: tuple[str, ...] = (), block: int = 4096) -> DataFrame:
    """``df`` with running sums (own row included) along the dense places
    ``at`` within each group of ``by``: ``sums`` maps columns to names of
    their sums.  A task sums blocks of ``block`` places; the blocks' totals
    are summed by group, so a group of any size is many tasks' work.  Without
    ``by``, totals (a row per block) are summed in blocks again."""
    df = df.withColumn("_block", F.expr(f"{at} div {block}"))
    keys = [*by, "_block"]
    totals = df.groupBy(*keys).agg(*[F.sum(c).alias(s) for c, s in sums.items()], F.count("*").alias("_n"))
    # a group's only block needs no sums before it
    if by:
        totals = totals.filter("_block > 0 OR _n >= " + str(block))
        before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    else:
        before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_{s}") for s in sums.values()])
    within = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    inner = df.select("*", *[F.sum(c).over(within).alias(s) for c, s in sums.items()])
    out = inner.join(offsets, keys, "left")
    for s in sums.values():
        out = out.withColumn(s, F.col(s) + F.coalesce(F.col(f"_{s}"), F.lit(0))).drop(f"_{s}")
    return out.drop("_block")
