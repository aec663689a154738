"""Session construction and the shared scratch location.

Jobs that have to materialise data (exports, streaming upserts, lineage
cuts) write below the folder the cluster names in ``spark.checkpoint.dir``.
A folder of our own is only set when that setting is missing, which is
the case in local tests.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcast a join side only on its size measured at run time (AQE);
    # the static, estimate-based threshold stays at Spark's default.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "blogweave", driver_memory: str | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # Local mode runs everything in the driver JVM: size its heap
            # (only effective when this call launches the JVM).
            builder = builder.config("spark.driver.memory", driver_memory or "12g")
    for k, v in _DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Sizing for a large cluster: splits and shuffle partitions of about
    ``partition_bytes`` each (so a task's data fits executor memory with
    room for sorting), at least two waves of tasks, AQE coalescing and
    skew splitting on.  Pass the result to ``SparkSession.builder.config``."""
    shuffle_parts = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.session.timeZone": "UTC",
    }


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the jobs rely on to a session built elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make the package importable by Python workers (``mapInPandas``).

    Nothing is done when the workers' ``PYTHONPATH`` already holds it (or
    the process runs from the repository).  Otherwise the package is zipped
    once per context into the shared checkpoint folder, if that folder is
    a local path, and added with ``addPyFile``; on a cluster with a remote
    checkpoint folder it is expected to be shipped with ``--py-files``.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: ship with the job submission instead
        return
    if id(sc) in _SHIPPED:
        return
    _SHIPPED.add(id(sc))
    import blogweave
    parent = os.path.dirname(os.path.dirname(os.path.abspath(blogweave.__file__)))
    paths = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if parent in paths or os.path.abspath(os.getcwd()) == parent:
        return
    root = ensure_checkpoint_dir(spark)
    local = root[len("file:"):] if root.startswith("file:") else root
    if "://" in local or not os.path.isabs(local):
        return
    target = os.path.join(local, "blogweave-pkg-" + uuid.uuid4().hex[:8])
    os.makedirs(target, exist_ok=True)
    archive = shutil.make_archive(os.path.join(target, "blogweave"), "zip", root_dir=parent, base_dir="blogweave")
    sc.addPyFile(archive)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # no context handle (remote session): the setting is all we have
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        # One machine only (tests): a folder of our own, gone at exit.
        configured = tempfile.mkdtemp(prefix="blogweave-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """Write ``df`` as Parquet to a fresh folder of the shared scratch area
    and read it back: lineage is cut (the result survives lost executors),
    the plan runs once, and the read side has real size statistics.
    ``metrics`` (aggregate columns) are observed during the same write."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = None
    if metrics:
        obs = Observation(name)
        df = df.observe(obs, *[c.alias(k) for k, c in metrics.items()])
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), (obs.get if obs else {})


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out evenly over the shuffle partitions: rows that take long
    each should not lie in the few tasks that their bytes would make."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "blogweave", f"{name}-{uuid.uuid4().hex[:12]}")
