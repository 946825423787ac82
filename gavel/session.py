"""Spark session and checkpoint-directory helpers.

On a cluster the session is created by the platform; ``configure`` only adds
the settings this engine relies on (AQE, UTC session time, Arrow) and reads the
shared checkpoint folder from ``spark.checkpoint.dir``.  A local folder is
created only when that setting is unset *and* the master is local (tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # per-key top-k filters (sample selection, context budgets) up to this k get
    # a partial limit before the shuffle, which bounds what a hot key sends
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    # base64 as Python's b64encode: one line, no MIME chunking
    "spark.sql.chunkBase64String.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "gavel", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session; ``master`` is only given in tests/bench."""
    b = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
        b = b.config("spark.driver.memory", os.environ.get("GAVEL_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for k, v in _RUNTIME_CONF.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; never invent one on a cluster."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset; point it at a shared folder")
    local = tempfile.mkdtemp(prefix="gavel-ckpt-")
    sc.setCheckpointDir(local)
    return local

