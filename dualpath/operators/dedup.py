"""Newest row per key and latest value per key and field."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep rank 1. Spark ranks inside each map task first, so a key with many copies shuffles few."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).where(F.col("_rn") == 1).drop("_rn")


def first_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).where(F.col("_rn") <= n).drop("_rn")


def pitch_recency() -> list[Column]:
    """Newest report first; ties go to the on-time copy, then the later clock, then the source position."""
    return [
        F.desc_nulls_last("ingest_time"),
        F.asc_nulls_last("is_late_arrival"),
        F.desc_nulls_last("event_time"),
        F.desc_nulls_last("kafka_partition"),
        F.desc_nulls_last("source_offset"),
    ]


def latest_per_field(
    corrections: DataFrame, keys: Sequence[str], fields: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per key with the latest new_value of each field as a column, by one aggregation."""
    recency = F.struct(*order)
    return corrections.groupBy(*keys).agg(
        *[
            F.max_by(F.when(F.col("field") == f, F.struct("new_value")), F.when(F.col("field") == f, recency))
            .getField("new_value")
            .alias(f)
            for f in fields
        ]
    )
