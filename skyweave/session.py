"""Session settings the library relies on, and the size rule for broadcasts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when its row count is known beforehand and at most this.
BROADCAST_ROW_LIMIT = 200_000


# Settings to start a cluster session with, besides its sizes (about 128 MB of shuffle data per partition).
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a broadcast is decided on sizes seen at run time, not on estimates that do not see what an explode makes
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def use_utc(spark: SparkSession) -> SparkSession:
    """All instants are UTC; every entry point calls this first."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "skyweave") -> SparkSession:
    """A local session for tests and the bench. On a cluster pass your own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call-site capture per column
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``; a fresh one only if unset in a local session."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="skyweave-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def join_sized(left: DataFrame, right: DataFrame, on: list[str], right_rows: int, how: str = "inner") -> DataFrame:
    """Join a *generated* right side whose row count is known.

    Catalyst cannot see how many rows an ``explode`` makes, so it would take a generated table for a
    small one and broadcast it. Below the limit the broadcast is asked for; above it a sort-merge join
    is, which also lets AQE split skewed keys.
    """
    if right_rows <= BROADCAST_ROW_LIMIT:
        return left.join(F.broadcast(right), on, how)
    return left.join(right.hint("merge"), on, how)
