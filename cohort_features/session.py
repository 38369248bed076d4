"""Session settings and lineage cutting.

Everything here is ordinary Spark configuration. The settings that matter at
scale are collected in ``SCALE_CONF`` so that a cluster job and the local tests
run the same plan shapes (AQE on, skew-join splitting on, UI off).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library should carry. AQE re-plans joins at
# runtime from real sizes (broadcast only when the measured side is small),
# coalesces small shuffle partitions and splits skewed join partitions: the
# stays of a subject holding a third of all rows are joined by many tasks.
# (That subject's events never need splitting: they are pre-aggregated per
# map task before any shuffle.)
SCALE_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when that costs an extra shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.session.timeZone": "UTC",
    # no per-call Python stack capture for error messages: it costs a JVM
    # round trip on every DataFrame/Column call while plans are being built
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(
    largest_shuffle_bytes: int,
    total_cores: int,
    target_partition_bytes: int = 128 * 1024**2,
    scan_split_bytes: int = 256 * 1024**2,
) -> dict[str, str]:
    """Partition sizing for a cluster run, to pass as ``build_session(extra=...)``.

    ``spark.sql.shuffle.partitions`` is the count AQE coalesces *down* from,
    so it must be large enough for the biggest shuffle: bytes / target size,
    and at least three waves of the cluster's cores. For the stay table of a
    100 TB event store (say 3 TB shuffled) on 1000 x 8 cores this gives
    ~24,000 partitions of ~128 MB, each sorted and joined within one task's
    memory; smaller shuffles are coalesced to the advisory size at runtime.
    Scans use larger splits (fewer, longer tasks over columnar files).
    """
    partitions = max(3 * total_cores, -(-largest_shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
    }


def build_session(
    master: str | None = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "cohort_features",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with ``SCALE_CONF`` applied.

    ``shuffle_partitions`` is the upper bound AQE coalesces down from; on a
    cluster size it to roughly input bytes / 128 MB for the largest shuffle.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for tables between steps: the one the session names in
    ``spark.checkpoint.dir`` (or set on its context), else the warehouse
    folder. Both are the session's own configuration and visible to every
    executor on a cluster; no folder is invented here."""
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    return (current or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


_WRITTEN: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder, noted for ``release``."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path through Spark's file system, wherever it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Delete everything this application wrote to ``scratch_path``s. Call it
    when the DataFrames that read them are done with, at the latest before
    the session stops."""
    for path in _WRITTEN.pop(spark.sparkContext.applicationId, []):
        remove(spark, path)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    This cuts the lineage (a lost executor re-reads the files instead of
    recomputing joins and aggregates) and gives later stages a columnar,
    prunable input. The files stay until ``release``.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
