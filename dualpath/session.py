"""Session settings and the shared folder that runs write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


# One partitioning by game serves joins and windows on longer keys that contain the game.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    CO_PARTITION: "false",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # A batch's commit writes what has changed; whole snapshots follow in the background.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Both sides of a stream join in one store instead of four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # The JVM does not compile methods above this many bytes; wide projections are split instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings the plans rely on to a session made elsewhere."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **RUNTIME, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by spark.checkpoint.dir.

    Only a local session may go without the setting; it gets a scratch folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there."""
    path = new_run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
