"""Session construction and shared scratch locations.

Scratch data (round trips, lineage cuts, stream checkpoints) always lives under the
folder the cluster names in ``spark.checkpoint.dir``. Only when that setting is absent
(local mode) do we create one and register it; on a cluster a missing setting is an
error, so no job there writes to a machine-local temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "strata",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None) -> SparkSession:
    """Session with AQE (runtime re-plan, partition coalescing, skew-join split) on."""
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
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster; set up a local one only if unset."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        configured = sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {sc.master}")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
        sc.setCheckpointDir(configured)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared root (one per call)."""
    return f"{shared_root(spark)}/strata-scratch/{name}-{uuid.uuid4().hex[:12]}"


def local_dir(path: str) -> str:
    """Filesystem form of a ``file:`` URI (for tests that create files by hand)."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total bytes below ``paths`` from file-system metadata (no data is read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(p)
        fs = hpath.getFileSystem(conf)
        if fs.exists(hpath):
            total += fs.getContentSummary(hpath).getLength()
    return total


def sizing(total_input_bytes: int, target_partition_bytes: int = 200 * 1024 ** 2,
           min_partitions: int = 8, max_partitions: int | None = None) -> dict[str, str]:
    """Shuffle and scan sizing for an input of ``total_input_bytes``.

    Initial shuffle partitions aim at ``target_partition_bytes`` of input per partition
    at any size; AQE then coalesces them to the advisory size measured at runtime.
    ``max_partitions`` bounds them only where the caller asks for it.
    """
    wanted = -(-total_input_bytes // target_partition_bytes)
    partitions = max(min_partitions, wanted)
    if max_partitions:
        partitions = min(partitions, max_partitions)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 ** 2),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 ** 2),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }


def apply_sizing(spark: SparkSession, paths: list[str], **kwargs) -> dict[str, str]:
    """Measure the inputs and set the runtime SQL confs of :func:`sizing`."""
    conf = sizing(input_bytes(spark, paths), **kwargs)
    for key, value in conf.items():
        spark.conf.set(key, value)
    return conf
