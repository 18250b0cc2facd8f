"""Session construction and the shared scratch folder.

On a cluster the scratch folder is whatever ``spark.checkpoint.dir`` names (a
shared file system path); we only pick our own when that setting is unset, which
is the case in local tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "chunkwise",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE, skew-join splitting and Arrow on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in _LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a local one only if unset.

    The setting is read from the session. When nothing names a folder (local
    runs), a temporary one is created and registered as the context's
    checkpoint directory, so ``checkpoint()`` and scratch paths agree.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="chunkwise-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared scratch folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def spread(df, *keys: str, min_partitions: int | None = None):
    """Hash-repartition ``df`` by ``keys`` when it has fewer partitions than cores.

    Text work (tokenising, encoding) is CPU-bound per row; a table stored as one
    row group would otherwise be processed by one task. Inputs that already have
    enough splits (any large table) are left alone: no extra shuffle at scale.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, *keys) if keys else df.repartition(target)
