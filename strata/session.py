"""Session setup and the shared scratch area.

Every job runs under a UTC session with AQE on. Anything this library writes
for itself (lineage cuts, staged table versions, stream checkpoints) goes below
the folder the cluster names in ``spark.checkpoint.dir``. A session without
that setting only gets a private temporary folder when it runs in local mode
(tests, the oracle check); on a cluster the setting is required.
"""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session gets unless the caller overrides them.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "strata",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    if "spark.sql.sources.parallelPartitionDiscovery.parallelism" not in settings:
        # listing a date-partitioned table launches one task per folder by
        # default (up to 10,000); one task per core lists the same folders
        # with a fraction of the scheduling
        spark.conf.set(
            "spark.sql.sources.parallelPartitionDiscovery.parallelism",
            str(spark.sparkContext.defaultParallelism),
        )
    ensure_utc(spark)
    checkpoint_root(spark)
    return spark


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle sizing for a cluster run over ``input_bytes`` of Parquet.

    Start wide (about one shuffle partition per ``target_partition_bytes`` of
    input, so no reducer spills) and let AQE coalesce what turns out small;
    AQE also splits skewed partitions of joins and rebalanced writes.
    """
    partitions = max(200, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(min(target_partition_bytes, 256 << 20)),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 << 20),
    }


def ensure_utc(spark: SparkSession) -> None:
    """Lenient typing and window boundaries assume a UTC session clock."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and staged writes.

    Read from the session. Only a local-mode session without the setting gets
    a fresh temporary folder; a cluster session must name a shared one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster job needs a shared folder "
            "for checkpoints and staged tables"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
    return sc.getCheckpointDir()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the Hadoop file system that serves it
    (local, HDFS or an object store alike)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/strata/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Apply SQL settings for the statements run inside the block only."""
    previous = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in previous.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# A write that fans out into many partition directories costs per file, not
# per byte: AQE's 1 MB floor would funnel a small table's rebalance into one
# task that creates every directory's file in turn. During such writes the
# floor is lowered so the files are created by all cores; a large table's
# partitions are far above it, so nothing changes at scale.
FANOUT_WRITE_CONF = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}
