"""File streams with their position, as a stand-in for topics."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    glob: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Streaming scan of a folder from its first file."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def with_file_position(stream: DataFrame, partitions: int = 3) -> DataFrame:
    """Add the source position of file rows: a partition from the file name and the row's index in it."""
    name = F.col("_metadata.file_name")
    return stream.select(
        "*",
        F.col("_metadata.row_index").alias("source_offset"),
        F.pmod(F.crc32(name.cast("binary")), F.lit(partitions)).cast("int").alias("kafka_partition"),
    )


# The given events table as a stream.
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def append_events(spark: SparkSession, sf_dir: str, folder: str, loads: int = 4) -> Iterator[int]:
    """Write the events to a folder in several appends by their position, one at each step.

    Each is dealt by position too, so that a load has files for all cores, however the table is stored, and near rows stay together.
    """
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    edges = [0] if low is None else [low + (high + 1 - low) * n // loads for n in range(loads)]
    for n, edge in enumerate(edges):
        load = events if n == 0 else events.where(F.col("event_id") >= edge)
        if n + 1 < len(edges):
            load = load.where(F.col("event_id") < edges[n + 1])
        load.repartitionByRange("event_id").write.mode("append").parquet(folder)
        yield n


def append_parts(rows: DataFrame, folder: str, part: Column, parts: int) -> Iterator[int]:
    """Write rows to a folder in appends numbered by `part`, one at each step."""
    for n in range(parts):
        rows.where(part == n).write.mode("append").parquet(folder)
        yield n


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_files(spark, sf_dir, EVENTS, glob="events.parquet")
