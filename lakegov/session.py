"""Session construction and the shared working folder.

Jobs that must cut lineage or stage intermediate tables write under the
folder the cluster names in ``spark.checkpoint.dir``. We only create a
folder of our own when that setting is absent (local runs and tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # dims are broadcast explicitly after a size check; keep the automatic
    # threshold modest so a fact table is never broadcast by accident.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # runtime (measured) broadcast conversion for derived join sides
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for the input volume rather than the cores.

    Scans are split into ~256 MB splits; the initial shuffle width is the
    input size over the target (at least 3 waves of the cluster's cores), and
    AQE coalesces it down to ~256 MB per reducer at run time and splits any
    partition 5x above the median (a key holding a third of the rows is
    split across many tasks instead of one). For 100 TB on 1000 executors x 8
    cores this gives ~400k initial shuffle partitions, coalesced by AQE."""
    parts = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> SparkSession:
    """Apply runtime SQL settings (e.g. ``scale_conf``) to a live session."""
    for k, v in conf.items():
        spark.conf.set(k, v)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "lakegov", driver_memory: str | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if driver_memory:  # only effective when this process launches the JVM (local runs)
        builder = builder.config("spark.driver.memory", driver_memory)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; created only when the cluster names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="lakegov-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    # SparkContext appends a per-application sub-folder; use the root we chose.
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for staged tables."""
    path = f"{checkpoint_root(spark)}/lakegov/{name}-{uuid.uuid4().hex[:12]}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    return path
