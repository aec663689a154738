"""Tables and binary files in the shared folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ..session import configure, scratch_path
from ..sources.tables import table_path


def bounded(spark: SparkSession) -> SparkSession:
    """The session with Arrow batches of a size that Python workers hold with ease."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return configure(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: the lineage
    ends there, and lost executors cost no more than their own tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fs(path: str):
    """File system and path; ``path`` may be a URI (file, hdfs, s3, gs) or local."""
    from pyarrow import fs
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:"):
            return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def write_file(path: str, write: Callable) -> None:
    """Write a file under a name of this attempt's own, then move it in place,
    so that a task that runs twice leaves one whole file."""
    fs, to = _fs(path)
    fs.create_dir(posixpath.dirname(to), recursive=True)
    part = f"{to}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as out:
        write(out)
    fs.move(part, to)


def open_file(path: str):
    fs, at = _fs(path)
    return fs.open_input_file(at)


def mapped(path: str) -> np.ndarray:
    """A file's bytes: mapped into memory where the shared folder is mounted,
    else read from its store."""
    fs, at = _fs(path)
    if type(fs).__name__ == "LocalFileSystem":
        return np.asarray(np.memmap(at, np.uint8, "r"))
    with fs.open_input_file(at) as file:
        return np.frombuffer(file.read(), np.uint8)


def folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)
