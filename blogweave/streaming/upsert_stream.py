"""Streaming upsert of records into a keyed collection.

A file-source stream of records; each micro-batch is merged into a
:class:`~blogweave.operators.collection.KeyedCollection`, which remembers the
stream's id and the batch's number: a batch that is replayed after a failure
changes nothing, and a stream with a new checkpoint is a new source whose
batches all count.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from blogweave.operators.collection import KeyedCollection
from blogweave.operators.upsert import KEYS, ORDER


def read_collection(spark: SparkSession, root: str) -> DataFrame | None:
    return KeyedCollection(spark, root).read()


def _stream_id(spark: SparkSession, checkpoint_dir: str) -> str:
    """The id that Spark gave the stream of this checkpoint."""
    return json.loads(spark.read.text(checkpoint_dir.rstrip("/") + "/metadata").first()[0])["id"]


def upsert_stream(spark: SparkSession, source_dir: str, schema: T.StructType, collection_root: str,
                  checkpoint_dir: str, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER,
                  buckets: int = 64, max_files_per_trigger: int | None = None, available_now: bool = True):
    """Start the stream; with ``available_now`` it stops after the input."""
    coll = KeyedCollection(spark, collection_root, buckets, keys, order)

    def merge(batch: DataFrame, batch_id: int) -> None:
        coll.merge(batch, _stream_id(spark, checkpoint_dir), batch_id)

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = reader.parquet(source_dir).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
