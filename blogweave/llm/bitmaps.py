"""Sets of 64-bit hashes as bitmaps of a fixed size, for tasks to filter by.

A bitmap has one bit for each value of a hash's first ``BITS`` bits: 2 MB,
whatever the size of the set.  What passes it is looked at exactly afterwards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textblocks import map_batches

BITS = 24
SECTION = 1 << 16


def bitmap_of(df: DataFrame, column: str) -> np.ndarray:
    """The bitmap of a column of hashes (long)."""
    schema = pa.schema([("byte", pa.int32()), ("bits", pa.int32())])

    def work(batch):
        bit = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - BITS)
        yield [(bit >> np.uint64(3)).astype(np.int32), (1 << (bit & np.uint64(7)).astype(np.int64)).astype(np.int32)]

    bits = (df.select(column).mapInArrow(map_batches(schema, work), "byte int, bits int")
            .groupBy("byte").agg(F.bit_or("bits").alias("bits")))
    return dense(bits, "byte", "bits", 1 << (BITS - 3), "<u1")


def dense(df: DataFrame, index: str, value: str, length: int, kind: str) -> np.ndarray:
    """An array of ``length`` numbers of numpy type ``kind``: ``value`` at each
    ``index``, else 0.  Tasks put sections of it together, so that the driver
    gets the array's bytes and no row per number."""
    def section(group: pa.Table) -> pa.Table:
        at = group.column(0).to_numpy().astype(np.int64)
        part = at[0] // SECTION
        out = np.zeros(min(SECTION, length - part * SECTION), kind)
        out[at - part * SECTION] = group.column(1).to_numpy()
        return pa.table({"part": pa.array([part], pa.int64()), "data": pa.array([out.tobytes()], pa.binary())})

    out = np.zeros(length, kind)
    for r in (df.select(index, value).groupBy(F.floor(F.col(index) / SECTION).alias("part"))
              .applyInArrow(section, "part long, data binary").collect()):
        some = np.frombuffer(r.data, kind)
        out[r.part * SECTION:r.part * SECTION + len(some)] = some
    return out


def passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes >> np.uint64(64 - BITS)
    return (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
