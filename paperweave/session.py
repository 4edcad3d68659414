"""Session settings and durable staging of intermediate results.

Staging writes a DataFrame as Parquet under the cluster's shared
``spark.checkpoint.dir`` and reads it back. That cuts lineage (iterative graph
rounds would otherwise grow their plans without bound), freezes
nondeterministic columns such as sampled range bounds or
``monotonically_increasing_id``, gives AQE real sizes, and survives the loss
of executors because the files live in shared storage, not on a node.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings for a job of this shape: many equi-joins on ids (AQE picks
# broadcast vs. sort-merge from real sizes and splits skewed partitions), a
# few hot vertices (skew join), and large sorts (range partitioning).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "paperweave", **conf) -> SparkSession:
    """Build (or reuse) a session with the recommended settings.

    ``spark.checkpoint.dir`` is taken from the cluster configuration; only when
    it is unset (local tests) is a local scratch directory chosen.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(RECOMMENDED_CONF)
    settings.setdefault("spark.ui.enabled", "false")
    settings.update(conf)
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared directory for staged data, as configured on the session.

    Order: the SparkContext's checkpoint directory, then the
    ``spark.checkpoint.dir`` setting. If neither exists and Spark runs in local
    mode, a scratch directory is created (tests); on a cluster this is an
    error, since node-local folders do not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage "
                "(HDFS, S3, ...) so staged data survives executor loss"
            )
        configured = tempfile.mkdtemp(prefix="paperweave-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def staging_root(spark: SparkSession) -> str:
    """This application's folder for staged data inside the checkpoint dir."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/staged/{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cleanup_staging(spark: SparkSession) -> None:
    """Delete everything this application staged (call once its outputs are written)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(staging_root(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


# Without it a shuffle's files stay until the driver happens to collect the plan that made them: over a job of many
# steps they add up to several times what any single step needs.
SPENT_SHUFFLES_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# Rows that come sorted by the key are grouped as they come, instead of by a hash table of objects that spills into a sort
SORTED_GROUPS_CONF = "spark.sql.execution.replaceHashWithSortAgg"


@contextmanager
def switched_on(spark: SparkSession, conf: str) -> Iterator[None]:
    """What is executed inside the block runs with the setting on."""
    before = spark.conf.get(conf, "false")
    spark.conf.set(conf, "true")
    try:
        yield
    finally:
        spark.conf.set(conf, before)


def spent_shuffles(spark: SparkSession):
    """What is executed inside the block deletes its shuffle files as it ends."""
    return switched_on(spark, SPENT_SHUFFLES_CONF)


_recorders: list[list[str]] = []


@contextmanager
def staged_paths() -> Iterator[list[str]]:
    """The folders that ``stage`` writes inside the block, so that a caller can ``discard`` them once they are spent."""
    paths: list[str] = []
    _recorders.append(paths)
    try:
        yield paths
    finally:
        _recorders.remove(paths)


def discard(spark: SparkSession, paths: list[str], reader: DataFrame | None = None) -> None:
    """Delete staged folders, but for those that ``reader`` still reads."""
    read = reader.inputFiles() if reader is not None and paths else []
    for folder in paths:
        if any(f"/{folder.rstrip('/').rsplit('/', 1)[1]}/" in f for f in read):
            continue
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str, *, partition_by: str | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` to Parquet in the shared checkpoint folder and read it back.

    The returned DataFrame has a fresh, short lineage (a file scan). Column
    order and types are preserved. The write's shuffle files are deleted as it ends. ``compression`` is
    for tables that stay long and are wide (``"zstd"``), default: the session's.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    for paths in _recorders:
        paths.append(path)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if compression:
        writer = writer.option("compression", compression)
    with spent_shuffles(spark):
        writer.parquet(path)
    return spark.read.parquet(path).select(*df.columns)


def drop_staged(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files behind a staged DataFrame (best effort)."""
    try:
        paths = df.inputFiles()
    except Exception:  # noqa: BLE001 - not a file-backed frame
        return
    if not paths:
        return
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    parent = jvm.org.apache.hadoop.fs.Path(paths[0]).getParent()
    fs = parent.getFileSystem(conf)
    if "/staged/" in parent.toString():
        fs.delete(parent, True)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": os.environ.get("PAPERWEAVE_DRIVER_MEMORY", "8g"),
    }
    settings.update(conf)
    return get_session(master=f"local[{cores}]", **settings)
