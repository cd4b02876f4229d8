"""Session settings and the shared folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime settings the plans rely on. A hot join key is split by AQE even where the split
# costs one more shuffle: that shuffle is cheaper than a task holding a third of the rows.
# Strict casts and overflow checks need ANSI mode.
RUNTIME_SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for staged tables.

    It is the one the cluster names in ``spark.checkpoint.dir``, else the checkpoint folder the
    application has set. Only a local master, where driver and executors are one process, may
    fall back to a temporary folder.
    """
    sc = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if known:
        return known
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="stakeline-"))
    return sc.getCheckpointDir()
