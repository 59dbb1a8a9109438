"""Spark session construction and cluster-shared scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session settings every job in this package relies on. AQE re-plans joins from
# runtime shuffle statistics (broadcast conversion, skew split, partition
# coalescing); UTC keeps timestamps identical across executors and the oracle.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_conf(input_bytes: int, executor_cores_total: int,
                 target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle sizing for a large cluster, derived from the input volume.

    The initial shuffle partition count is sized so that one reducer gets about
    ``target_partition_bytes`` of map output if nothing is reduced map-side
    (at least two waves of the available cores); AQE then coalesces small
    partitions towards the advisory size and splits skewed ones. At 100 TB
    this is ~400,000 partitions, handled by AQE coalescing rather than
    hand-tuning per query.
    """
    parts = max(2 * executor_cores_total, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        # runtime broadcast of a join side only below this measured size
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "lakeforge", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests pass
    ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder in that setting; it is only filled in here
    when unset on a local master (tests), with a fresh private folder. On a cluster
    without the setting there is no folder that all executors see, so this raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="lakeforge-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _file_system(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path`` (none where it does not exist)."""
    p, fs = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _file_system(spark, path)
    fs.delete(p, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to ``target``, in place of what is there."""
    src, fs = _file_system(spark, source)
    dst, _ = _file_system(spark, target)
    fs.delete(dst, True)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise RuntimeError(f"could not move {source} to {target}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), name)
