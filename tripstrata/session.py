"""Session settings the operators expect."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

# Set only where the caller or the cluster has not decided already.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more exchange for the aggregate above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # HotSpot leaves methods above 8000 bytes of bytecode uncompiled; wide feature projections
    # run several times faster as separate operators than as one such method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(app: str = "tripstrata", cores: int | None = None, **conf) -> SparkSession:
    """Session with the defaults above.

    ``cores`` starts a local session; without it the master comes from ``spark-submit``.
    On a cluster leave ``spark.sql.shuffle.partitions`` high (a few per core): adaptive
    execution merges small partitions, it does not split ones that are too large.
    """
    builder = SparkSession.builder.appName(app)
    local = {}
    if cores:
        builder = builder.master(f"local[{cores}]")
        local = {
            "spark.sql.shuffle.partitions": str(cores),
            "spark.ui.enabled": "false",
            # Python workers of this machine: without the waits of a loopback connection, which small jobs consist of.
            "spark.python.unix.domain.socket.enabled": "true",
            "spark.driver.memory": os.environ.get("SPARK_DRIVER_MEMORY", "12g"),
        }
    for key, value in (local | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    decided = spark.conf.getAll
    for key, value in DEFAULTS.items():
        if key not in decided:
            spark.conf.set(key, value)
    return spark


def share_package(spark: SparkSession) -> None:
    """Let Python workers on this machine find this package where only the driver's path names it; on a cluster it comes with ``--py-files``."""
    root = str(Path(__file__).resolve().parent.parent)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{paths}" if paths else root
