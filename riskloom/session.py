"""Session settings and the shared working folder.

On a cluster the operator never picks a machine-local folder: every
intermediate write (lineage cuts, stream checkpoints, round-trip tables)
goes below ``spark.checkpoint.dir``, which the cluster names. Only when
that setting is absent (local tests) is a private temporary folder
created and registered.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Fixed runtime settings (see SURVEY §7.5).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "riskloom", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench; production sessions come from the cluster."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("RISKLOOM_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder; set a private one only if unset."""
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        # A temporary folder is private to one machine: fine for a local session, never for a cluster.
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {sc.master}")
        conf_dir = tempfile.mkdtemp(prefix="riskloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one write."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def apply_settings(spark: SparkSession) -> None:
    """Settings every operator relies on (UTC clock, dynamic partition overwrite)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


# Target bytes per task for scans and shuffles.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024
SKEW_FACTOR = 5


def scale_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Settings sized to the data, for a cluster session (apply with ``spark.conf.set``).

    Shuffle partitions start at input/128 MiB (at least 2x the cores) and
    AQE coalesces small ones at runtime; a partition more than 5x the median
    and above 256 MiB is split by the skew-join rule. At 100 TB this gives
    ~800k initial shuffle partitions, coalesced to what each stage needs.
    """
    parts = max(2 * total_cores, -(-input_bytes // TARGET_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": str(SKEW_FACTOR),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
