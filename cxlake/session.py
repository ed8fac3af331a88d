"""Session helpers.

The library never creates a session on its own inside an operator: callers
pass one in. ``get_or_create_session`` exists for tests, ``bench.py`` and
command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Dates in the usage logs are UTC; month keys and day boundaries must not move
# with the machine's zone.
SESSION_TIME_ZONE = "UTC"


def cluster_conf(
    shuffle_bytes: int = 0, target_partition_bytes: int = 256 << 20, max_partitions: int | None = None
) -> dict[str, str]:
    """Settings for large inputs (pass to ``spark-submit --conf``).

    ``shuffle.partitions`` is an upper bound sized from the expected largest
    shuffle (AQE coalesces down from it at run time, it cannot split up), so
    every reduce task stays near ``target_partition_bytes`` and fits in
    executor memory without heavy spilling. ``max_partitions`` bounds it where
    the driver's map-output bookkeeping asks for that."""
    partitions = max(200, shuffle_bytes // target_partition_bytes)
    if max_partitions is not None:
        partitions = min(partitions, max_partitions)
    return {
        "spark.sql.session.timeZone": SESSION_TIME_ZONE,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def ensure_session_defaults(spark: SparkSession) -> SparkSession:
    """Pin the settings the operators rely on (idempotent, cheap)."""
    if spark.conf.get("spark.sql.session.timeZone") != SESSION_TIME_ZONE:
        spark.conf.set("spark.sql.session.timeZone", SESSION_TIME_ZONE)
    return spark


def use_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged results, set as the session's checkpoint folder.

    Read from the session (``spark.checkpoint.dir``, or a checkpoint folder that
    was set already). Only a local master may do without: it gets a fresh local
    folder. On a cluster a missing folder is an error, since executors do not
    share local disks."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="cxlake-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def staging_path(spark: SparkSession, what: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    return f"{use_checkpoint_dir(spark).rstrip('/')}/cxlake-{what}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a staged path through the file system that holds it."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def get_or_create_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "cxlake",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Local/test session with the defaults the library expects.

    On a cluster, ``master`` is left to ``spark-submit`` and
    ``shuffle_partitions`` should be sized to the data (AQE coalesces small
    partitions at run time, so erring high is cheaper than erring low).
    """
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    builder = (
        SparkSession.builder.appName(app_name)
        .master(master or f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", SESSION_TIME_ZONE)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
    )
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    use_checkpoint_dir(spark)
    return ensure_session_defaults(spark)
