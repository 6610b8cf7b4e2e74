"""Session settings for tests and the bench; on a cluster the caller's session is used as it is."""

from __future__ import annotations

import tempfile

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# AQE re-plans joins from measured sizes: it broadcasts a side that proves small and
# splits a join partition that proves hot, so no operator here forces either by hint.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # both sides of a forecast-actual join are already partitioned by series: keep that
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, app: str = "demandloom", memory: str = "8g",
                  **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.driver.memory", memory)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a scratch one only where none is named.

    An unset folder on anything but a local master is an error: executors could not
    share a machine-local path.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def use_checkpoints(spark: SparkSession) -> None:
    """Point reliable checkpoints at the shared folder unless the session already has one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))


def ship_code() -> None:
    """Send the package's own functions with each task, so that workers need no copy of it."""
    import demandloom

    cloudpickle.register_pickle_by_value(demandloom)
