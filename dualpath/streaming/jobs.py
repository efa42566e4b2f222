"""Streaming jobs: windowed counts, the bronze append, several sinks from one source.

Event time only. Give a checkpoint one shuffle-partition setting for its whole life; the keyed state
is laid out by it.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dualpath.schemas import BRONZE_PITCH

# Watermark delay, window size and checkpoint interval.
WATERMARK_DELAY = "5 minutes"
WINDOW_SIZE = "1 minute"
CHECKPOINT_EVERY = "30 seconds"


# Bytes of input files a state partition. Each is a task, a Python process and a commit in every batch of every operator.
STATE_BYTES = 1 << 23


def state_partitions(spark: SparkSession, path: str) -> int:
    """Of a stateful stream over the files at `path`: one per STATE_BYTES, a core each at least, no more than shuffles have."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(most, max(spark.sparkContext.defaultParallelism, math.ceil(size / STATE_BYTES)))


def windowed_counts(pitches: DataFrame, delay: str = WATERMARK_DELAY, size: str = WINDOW_SIZE) -> DataFrame:
    """Pitches per (game, pitcher, tumbling window); on a stream, windows close at the watermark."""
    return (
        pitches.withWatermark("event_time", delay)
        .groupBy("game_pk", "pitcher_id", F.window("event_time", size).alias("w"))
        .agg(F.count(F.lit(1)).alias("pitch_count"))
        .select(
            "game_pk",
            "pitcher_id",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "pitch_count",
        )
    )


def refused_by_watermark(run: StreamingQuery) -> int:
    """Groups that a run's stateful operators refused as late, as its progress reports say."""
    return sum(o["numRowsDroppedByWatermark"] for p in run.recentProgress for o in p["stateOperators"])


def missing_from_counts(bronze: DataFrame, counts: DataFrame, upto: DataFrame, size: str = WINDOW_SIZE) -> DataFrame:
    """Closed windows whose counts lack rows that bronze keeps: the late rows that the windows refused.

    `upto` is one row with the end of the last closed window.
    """
    key = ["game_pk", "pitcher_id", "window_start"]
    kept = bronze.groupBy("game_pk", "pitcher_id", F.window("event_time", size).alias("w")).agg(F.count(F.lit(1)).alias("kept"))
    kept = kept.select("game_pk", "pitcher_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "kept")
    both = kept.where(F.col("window_end") <= upto.scalar()).join(counts.select(*key, "pitch_count"), key, "left")
    missing = F.col("kept") - F.coalesce("pitch_count", F.lit(0))
    return both.select(*key, missing.alias("refused")).where("refused > 0")


def arrival_rows(pitches: DataFrame) -> DataFrame:
    """The two columns the print sink shows."""
    return pitches.select("pitcher_id", "event_time")


def bronze_rows(pitches: DataFrame) -> DataFrame:
    """The bronze projection with its audit columns and day; every row, late or not.

    `pitches` carries source_offset and kafka_partition.
    """
    audited = pitches.withColumn("ingestion_time", F.current_timestamp())
    return audited.select(*[f.name for f in BRONZE_PITCH], F.to_date("event_time").alias("event_day"))


def _start(df: DataFrame, checkpoint: str, once: bool, configure) -> StreamingQuery:
    writer = configure(df.writeStream.option("checkpointLocation", checkpoint).outputMode("append"))
    trigger = {"availableNow": True} if once else {"processingTime": CHECKPOINT_EVERY}
    return writer.trigger(**trigger).start()


def append_files(
    df: DataFrame, path: str, checkpoint: str, partitions: tuple[str, ...] = (), once: bool = False
) -> StreamingQuery:
    """Exactly-once append to a Parquet folder."""
    return _start(
        df, checkpoint, once, lambda w: w.format("parquet").partitionBy(*partitions).option("path", path)
    )


def append_batches(df: DataFrame, path: str, checkpoint: str, change: Callable[[DataFrame], DataFrame], once: bool = False) -> StreamingQuery:
    """Each batch, changed as a whole, to a folder of its own that a repeated batch overwrites."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        change(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return _start(df, checkpoint, once, lambda w: w.foreachBatch(handle))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")


def append_bronze(pitches: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    return append_files(bronze_rows(pitches), path, checkpoint, ("event_day",), once)


def print_rows(df: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
    return _start(df, checkpoint, once, lambda w: w.format("console").option("truncate", "false"))


def start_smoke_job(pitches: DataFrame, root: str, once: bool = False) -> list[StreamingQuery]:
    """One source, three sinks: arrivals and bronze from each batch read once, and windowed counts.

    A repeated batch overwrites its own folders. The counts hold watermark state, so they are a query
    of their own.
    """

    def both(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        for name, rows in {
            "arrivals": arrival_rows(batch),
            "bronze": bronze_rows(batch).drop("event_day"),
        }.items():
            rows.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")
        batch.unpersist()

    return [
        _start(pitches, f"{root}/checkpoint/batches", once, lambda w: w.foreachBatch(both)),
        append_files(windowed_counts(pitches), f"{root}/counts", f"{root}/checkpoint/counts", once=once),
    ]


def wait_all(queries: list[StreamingQuery], seconds: int | None = None) -> None:
    for q in queries:
        q.awaitTermination(seconds)

