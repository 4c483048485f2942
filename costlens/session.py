"""Session helpers: recommended settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the plans are designed around (all standard Spark options).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_conf(checkpoint_root: str, executors: int = 1000, cores_per_executor: int = 8,
                 shuffle_mb_per_task: int = 256) -> dict:
    """Settings for the production scale (~100 TB of sources, ~1000 executors).

    * many initial shuffle partitions (several per core) so no reducer holds
      more than a few hundred MB; AQE coalesces the small ones at runtime to
      the advisory size and splits skewed join partitions;
    * large input splits: the sources are read once per plan, column-pruned
      and date-filtered in the scan;
    * the broadcast threshold stays Spark's default, and the plans of the
      reference's operators carry no broadcast hints;
    * ``checkpoint_root`` is a folder on storage that all executors share.
    """
    cores = executors * cores_per_executor
    return dict(RECOMMENDED_CONF, **{
        "spark.checkpoint.dir": checkpoint_root,
        "spark.sql.shuffle.partitions": str(max(2 * cores, 200)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{shuffle_mb_per_task}m",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * shuffle_mb_per_task}m",
        "spark.sql.files.maxPartitionBytes": "512m",
        "spark.sql.parquet.aggregatePushdown": "true",
    })


def build_session(master: str = "local[8]", app: str = "costlens",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this setting names shared storage and is always used as is.
    Only on a ``local[...]`` master, where there is but one machine, a scratch
    folder is created when it is unset; anywhere else that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="costlens-ckpt-", dir=os.environ.get("COSTLENS_SCRATCH", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location (for written tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_released(spark: SparkSession):
    """Queries built and run inside leave no shuffle files: those of a finished step would else
    stay on the executors' disks until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
