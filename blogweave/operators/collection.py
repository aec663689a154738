"""Keyed collections: a partitioned Parquet snapshot and one pointer file.

A record's bucket is a hash of its key; ``<root>/data/v=<version>/b=<bucket>``
holds a bucket as some merge wrote it, and ``<root>/CURRENT`` (JSON) names the
folder of every bucket, the columns and, per source, the last batch merged.
A merge reads and rewrites the buckets of its keys only, then replaces the
pointer in one step: a merge that dies before has changed nothing, and a batch
that comes again is known by its number.  One writer at a time is assumed;
readers see the pointer's state whenever they read it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blogweave.operators.upsert import KEYS, ORDER, latest_per_key, upsert

POINTER = "CURRENT"


class KeyedCollection:
    """``buckets`` counts when the collection is created; choose it so that a
    bucket is what one merge should read and rewrite at least."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64,
                 keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.keys, self.order = tuple(keys), tuple(order)

    def _hadoop(self):
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return jvm.org.apache.hadoop.fs, conf

    def _pointer(self) -> dict:
        fs, conf = self._hadoop()
        path = fs.Path(f"{self.root}/{POINTER}")
        system = path.getFileSystem(conf)
        if not system.exists(path):
            return {"version": 0, "buckets": self.buckets, "paths": {}, "schema": None, "merged": {}}
        stream = system.open(path)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _point(self, state: dict) -> None:
        fs, conf = self._hadoop()
        path, new = fs.Path(f"{self.root}/{POINTER}"), fs.Path(f"{self.root}/{POINTER}.{state['version']}")
        out = path.getFileSystem(conf).create(new, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        rename = getattr(fs, "Options$Rename")
        option = self.spark.sparkContext._gateway.new_array(rename, 1)
        option[0] = rename.OVERWRITE
        fs.FileContext.getFileContext(path.toUri(), conf).rename(path.getFileSystem(conf).makeQualified(new),
                                                                 path.getFileSystem(conf).makeQualified(path), option)

    def _read(self, state: dict, buckets: Sequence[str]) -> DataFrame | None:
        paths = [state["paths"][b] for b in buckets if b in state["paths"]]
        if not paths:
            return None
        return self.spark.read.schema(T.StructType.fromJson(state["schema"])).parquet(*paths)

    def version(self) -> int:
        """Number of merges that wrote something."""
        return self._pointer()["version"]

    def read(self) -> DataFrame | None:
        """The current records; None for a collection that was never written."""
        state = self._pointer()
        return self._read(state, sorted(state["paths"], key=int))

    def merge(self, batch: DataFrame, source: str | None = None, batch_id: int | None = None) -> list[int]:
        """Merge ``batch`` (last write wins; records without a key are left
        out); returns the buckets rewritten.  With a ``source`` and the
        batch's number there, a batch that was merged before is skipped."""
        state = self._pointer()
        if source is not None and batch_id is not None and state["merged"].get(source, -1) >= batch_id:
            return []
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(state["buckets"])).cast("int")
        latest = latest_per_key(batch, self.keys, self.order).persist(StorageLevel.DISK_ONLY)
        try:
            touched = [r[0] for r in latest.select(bucket).distinct().collect()]       # at most as many as buckets
            if touched:
                merged = upsert(self._read(state, [str(b) for b in touched]), latest, self.keys, self.order)
                version = state["version"] + 1
                out = f"{self.root}/data/v={version:012d}"
                # a bucket is as many tasks' work as its size asks for
                (merged.withColumn("b", bucket).hint("rebalance", "b").write.mode("overwrite").partitionBy("b").parquet(out))
                state["version"], state["schema"] = version, merged.schema.jsonValue()
                state["paths"].update({str(b): f"{out}/b={b}" for b in touched})
        finally:
            latest.unpersist()
        if source is not None and batch_id is not None:
            state["merged"][source] = batch_id
        if touched or source is not None:
            self._point(state)
        return sorted(touched)

    def expire(self, keep: int = 2) -> list[int]:
        """Delete the versions that no bucket reads any more, but the newest
        ``keep`` (for readers that read the pointer just before)."""
        state = self._pointer()
        fs, conf = self._hadoop()
        data = fs.Path(f"{self.root}/data")
        system = data.getFileSystem(conf)
        if not system.exists(data):
            return []
        live = {int(p.rsplit("/v=", 1)[1].split("/")[0]) for p in state["paths"].values()}
        dead = [v for v in (int(s.getPath().getName()[2:]) for s in system.listStatus(data))
                if v not in live and v <= state["version"] - keep]
        for v in sorted(dead):
            system.delete(fs.Path(f"{self.root}/data/v={v:012d}"), True)
        return sorted(dead)
