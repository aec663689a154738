"""Keyed collections: last write wins per (``_type``, ``_id``).

A collection is a Parquet snapshot.  An upsert is one aggregation over
``old ∪ batch`` keeping, per key, the whole record with the greatest
(``updated_at``, ``seq``); replaying a batch changes nothing (idempotent).
``max_by`` over whole records plans as a sort-based aggregation: each task
sorts its records by key and keeps one per key before the shuffle, so a hot
key (many versions of one document) is reduced there.  Records with a null in
a key belong to no document and are left to :func:`keyless`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("_type", "_id")
ORDER = ("updated_at", "seq")


def _keyed(keys: Sequence[str]):
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def keyless(records: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Dead letters: the records that have no key."""
    return records.where(~_keyed(keys))


def latest_per_key(records: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER) -> DataFrame:
    """One record per key: the one with the greatest ``order`` tuple."""
    payload = [c for c in records.columns if c not in keys]
    records = records.where(_keyed(keys))
    agg = records.groupBy(*keys).agg(
        F.max_by(F.struct(*payload), F.struct(*order)).alias("_latest"))
    return agg.select(*keys, *[F.col("_latest")[c].alias(c) for c in payload])


def upsert(collection: DataFrame | None, batch: DataFrame, keys: Sequence[str] = KEYS,
           order: Sequence[str] = ORDER) -> DataFrame:
    """New snapshot: every key of ``collection`` and ``batch``, latest version.
    Columns that only one of them has are null in the other's records."""
    both = batch if collection is None else collection.unionByName(batch, allowMissingColumns=True)
    return latest_per_key(both, keys, order)


def with_record_keys(df: DataFrame, type_col: str, id_cols: Sequence[str], updated_col: str,
                     seq_col: str | None = None) -> DataFrame:
    """Add ``_type``, ``_id`` (``a/b`` for composite ids), ``updated_at``, ``seq``.

    ``concat`` (not ``concat_ws``) so a null id part gives a null key.
    """
    parts = []
    for i, c in enumerate(id_cols):
        if i:
            parts.append(F.lit("/"))
        parts.append(F.col(c).cast("string"))
    return df.select(
        F.col(type_col).alias("_type"), F.concat(*parts).alias("_id"),
        F.col(updated_col).alias("updated_at"),
        (F.col(seq_col) if seq_col else F.lit(0)).cast("bigint").alias("seq"),
        *[c for c in df.columns if c not in (type_col, updated_col)])
