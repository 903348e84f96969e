"""Session settings and the shared scratch folder.

The library never creates a session inside an operator; callers pass one in.
``local_session`` is for tests and the benchmark only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every run should have: adaptive execution (runtime re-planning,
# partition coalescing and skew-join splitting), UTC and no web UI.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


# Settings for a large cluster reading ~100 TB. The initial shuffle partition
# count is high and adaptive execution coalesces it to the advisory size, so
# every shuffle partition fits an executor's memory whatever the input size;
# skewed join partitions above the threshold are split; input splits stay at
# 256 MB; a broadcast is allowed up to 64 MB of estimated size (code tables
# are checked by row count before they are broadcast in any case).
CLUSTER_CONF = {
    **{k: v for k, v in RECOMMENDED_CONF.items() if k != "spark.ui.enabled"},
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def apply_conf(spark: SparkSession, conf: dict[str, str] | None = None, only_unset: bool = True) -> dict[str, str]:
    """Set runtime SQL settings (``CLUSTER_CONF`` by default) on a session.

    With ``only_unset`` a value the cluster already configured is kept.
    Returns the settings that were changed.
    """
    configured = spark.sparkContext.getConf()
    changed = {}
    for key, value in (CLUSTER_CONF if conf is None else conf).items():
        if key == "spark.ui.enabled" or (only_unset and configured.contains(key)):
            continue
        spark.conf.set(key, value)
        changed[key] = value
    return changed


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "starmart") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
               .config("spark.driver.memory", os.environ.get("STARMART_DRIVER_MEMORY", "16g")))
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    It is the session's ``spark.checkpoint.dir``. Without one, a session that runs in a single process (tests) uses
    a folder of the system's temporary directory; on a cluster that would be a folder of one machine, so it raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = os.path.join(tempfile.gettempdir(), "starmart-checkpoints")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/starmart-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder, in the folder of this application."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and its ``Path`` class: shared folders are never touched as local files."""
    cls = spark._jvm.org.apache.hadoop.fs.Path
    return cls(path).getFileSystem(spark._jsc.hadoopConfiguration()), cls


def clean_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote below ``scratch_path``; call it when no result is read any more."""
    root = _scratch_root(spark)
    files, path = file_system(spark, root)
    files.delete(path(root), True)
