"""Parquet lake tables with day partitions, committed snapshots, and SQL over named views.

Where Iceberg is on the classpath, point the session at it with iceberg_conf() and use its own
snapshots. Otherwise a snapshot is a partition value: a commit writes its rows under a new
snapshot_id and then adds one row to the table's commit log, and readers see logged commits only.
One writer per table.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The layers of the lake and its declared relations.
NAMESPACES = ("bronze", "silver", "gold")
BRONZE_RELATIONS = {
    "pitches": "bronze.pitches",
    "game_state": "bronze.game_state",
    "corrections": "bronze.corrections",
    "alerts": "bronze.alerts",
}

SNAPSHOT = "snapshot_id"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def iceberg_conf(catalog: str, uri: str, warehouse: str) -> dict[str, str]:
    """Session settings that attach a REST catalog. Needs the Iceberg package."""
    name = f"spark.sql.catalog.{catalog}"
    return {
        name: "org.apache.iceberg.spark.SparkCatalog",
        f"{name}.type": "rest",
        f"{name}.uri": uri,
        f"{name}.warehouse": warehouse,
    }


def day_range(since: datetime.datetime | None, until: datetime.datetime | None) -> Column:
    """event_time bounds together with the event_day bounds they imply, so whole days are pruned."""
    keep = F.lit(True)
    if since is not None:
        keep = keep & (F.col("event_time") >= F.lit(since)) & (F.col("event_day") >= F.lit(since.date()))
    if until is not None:
        keep = keep & (F.col("event_time") < F.lit(until)) & (F.col("event_day") <= F.lit(until.date()))
    return keep


class Lake:
    """Tables under one root folder, in databases named by layer and an optional suffix."""

    def __init__(self, spark: SparkSession, root: str, suffix: str = "") -> None:
        self.spark, self.root, self.suffix = spark, root.rstrip("/"), suffix

    def _name(self, identifier: str) -> str:
        namespace, table = identifier.split(".", 1)
        return f"`{namespace}{self.suffix}`.`{table}`"

    def _log(self, identifier: str) -> str:
        return self._name(f"{identifier}__commits")

    def create_namespaces(self) -> None:
        for n in NAMESPACES:
            place = f"{self.root}/{n}"
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{n}{self.suffix}` LOCATION '{place}'")

    def ensure_table(self, identifier: str, schema: T.StructType, partitions: list[str]) -> None:
        """Create the table if it is missing; partition columns come last."""
        fields = [f for f in schema if f.name not in partitions] + [schema[p] for p in partitions]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._name(identifier)} ({columns}) USING parquet "
            f"PARTITIONED BY ({', '.join(partitions)})"
        )

    def ensure_snapshot_table(self, identifier: str, schema: T.StructType) -> None:
        """A table partitioned by commit and by the day of event_time, with its commit log."""
        full = T.StructType(
            [f for f in schema if f.name != "event_day"]
            + [T.StructField(SNAPSHOT, T.LongType()), T.StructField("event_day", T.DateType())]
        )
        self.ensure_table(identifier, full, [SNAPSHOT, "event_day"])
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._log(identifier)} "
            f"({SNAPSHOT} BIGINT, committed_at TIMESTAMP) USING parquet"
        )

    def recreate(self, identifier: str, schema: T.StructType, confirm: bool = False) -> None:
        """Drop the table with its files and create it empty; only when confirmed."""
        if not confirm:
            raise ValueError(f"recreate deletes all rows of {identifier}; pass confirm=True")
        for name in (self._name(identifier), self._log(identifier)):
            self.spark.sql(f"DROP TABLE IF EXISTS {name} PURGE")
        self.ensure_snapshot_table(identifier, schema)

    def current_snapshot(self, identifier: str) -> int | None:
        """Id of the last commit; None before the first."""
        return self.snapshots(identifier).agg(F.max(SNAPSHOT)).first()[0]

    def snapshots(self, identifier: str) -> DataFrame:
        return self.spark.table(self._log(identifier))

    def commit(self, df: DataFrame, identifier: str, snapshot: int | None = None) -> int:
        """Write the rows as one snapshot. Repeating an id replaces what that id wrote."""
        if snapshot is None:
            last = self.current_snapshot(identifier)
            snapshot = 0 if last is None else last + 1
        name = self._name(identifier)
        rows = df.withColumn("event_day", F.to_date("event_time")).hint("rebalance", "event_day")
        view = f"commit_{uuid.uuid4().hex}"
        rows.createOrReplaceTempView(view)
        columns = ", ".join(f"`{c}`" for c in self.spark.table(name).columns if c != SNAPSHOT)
        before = self.spark.conf.get(OVERWRITE_MODE)
        # Static: all days of this id go, those included that only an earlier try of it wrote.
        self.spark.conf.set(OVERWRITE_MODE, "static")
        try:
            self.spark.sql(
                f"INSERT OVERWRITE TABLE {name} PARTITION ({SNAPSHOT} = {snapshot}, event_day) SELECT {columns} FROM {view}"
            )
        finally:
            self.spark.conf.set(OVERWRITE_MODE, before)
            self.spark.catalog.dropTempView(view)
        if not self.snapshots(identifier).where(F.col(SNAPSHOT) == snapshot).isEmpty():
            return snapshot
        entry = self.spark.range(1).select(
            F.lit(snapshot).cast("bigint").alias(SNAPSHOT), F.current_timestamp().alias("committed_at")
        )
        entry.write.insertInto(self._log(identifier))
        return snapshot

    def overwrite_partitions(self, df: DataFrame, identifier: str, partition: str | None = None) -> None:
        """Replace exactly the partitions the rows belong to."""
        name = self._name(identifier)
        ordered = df.select(*self.spark.table(name).columns)
        if partition:
            # Few files per partition; a partition too big for one task is split again.
            ordered = ordered.hint("rebalance", partition)
        before = self.spark.conf.get(OVERWRITE_MODE)
        self.spark.conf.set(OVERWRITE_MODE, "dynamic")
        try:
            ordered.write.insertInto(name, overwrite=True)
        finally:
            self.spark.conf.set(OVERWRITE_MODE, before)

    def read(self, identifier: str, snapshot: int | None = None) -> DataFrame:
        """All rows up to a commit, by default the last one. Filters and columns reach the scan."""
        if snapshot is None:
            snapshot = self.current_snapshot(identifier)
        rows = self.spark.table(self._name(identifier))
        return rows.where(F.col(SNAPSHOT) <= F.lit(-1 if snapshot is None else snapshot))

    def read_plain(self, identifier: str) -> DataFrame:
        return self.spark.table(self._name(identifier))

    def register_views(self, view_map: dict[str, str]) -> None:
        for view, identifier in view_map.items():
            self.read(identifier).createOrReplaceTempView(view)

    def query(self, sql: str, view_map: dict[str, str]) -> DataFrame:
        """SQL over the named tables; a DataFrame serves rows (collect) and frames (toPandas)."""
        self.register_views(view_map)
        return self.spark.sql(sql)

    def query_snapshot(self, sql: str, identifier: str, snapshot: int, view: str) -> DataFrame:
        """SQL over one table as it was at a commit."""
        self.read(identifier, snapshot).createOrReplaceTempView(view)
        return self.spark.sql(sql)

    def count_rows(self, identifier: str, where: str | None = None) -> int:
        rows = self.read(identifier)
        return (rows.where(where) if where else rows).count()
