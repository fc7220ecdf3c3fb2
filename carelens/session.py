"""Spark session and checkpoint-directory helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on.  Dates are calendar dates, so the session
# time zone only matters for timestamp inputs; UTC keeps casts stable.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "carelens",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the reliable checkpoint directory of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is
    used as is.  Only when nothing is configured *and* the master is local
    (tests) do we create a private folder under /tmp.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect: the server's setting applies)
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    path = tempfile.mkdtemp(prefix="carelens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
