"""Session construction and the shared folder for written tables.

Settings that every job relies on: UTC session time zone (timestamps
compare equal to the oracle's naive ones), ANSI mode left on, adaptive
execution with partition coalescing and skew-join splitting, no web UI.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # No Python call-site capture per functions.* call (four Py4J round
    # trips each); it only decorates error messages.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "tripscope",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or join) a session with the settings above.

    ``shuffle_partitions`` sizes the initial shuffle; AQE coalesces small
    partitions afterwards, so on a cluster it should be sized for the
    largest stage (about input bytes / 128 MiB), not for the smallest.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """Folder for tables the jobs write and read back.

    The cluster names it in ``spark.checkpoint.dir``; it is read from the
    session and never replaced.  Only a local session without one gets a
    fresh folder of its own (tests, the bench); a cluster session without
    one is an error, since a machine-local folder is not visible to the
    executors.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared folder for it"
            )
        base = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scale_conf(
    input_bytes: int,
    total_cores: int,
    executor_memory_gb: float = 8.0,
    cores_per_executor: int = 4,
    target_partition_mb: int = 256,
) -> dict[str, str]:
    """Sizing settings for a cluster run over ``input_bytes`` of Parquet.

    - scan splits of ``target_partition_mb`` (fewer, larger tasks; each task
      holds about one split decoded, so a split must fit its share of
      executor memory: memory / cores, with room for the shuffle buffers);
    - initial shuffle partitions = input / split size, at least 2 waves of
      the cluster's cores; AQE coalesces the small ones after each stage
      and splits skewed ones (a key with a third of the rows) in joins;
    - advisory partition size = half a split, the size AQE aims for.
    """
    per_task_mb = executor_memory_gb * 1024 / max(cores_per_executor, 1)
    split_mb = max(32, min(target_partition_mb, int(per_task_mb / 4)))
    partitions = max(2 * total_cores, -(-input_bytes // (split_mb * 1024 * 1024)))
    return {
        "spark.sql.files.maxPartitionBytes": f"{split_mb}m",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{max(16, split_mb // 2)}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{split_mb * 2}m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }

