"""What the two vector searches share: usable vectors, one per id, and groups of rows as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_EVERY = 50


def finite(vector: Column) -> Column:
    """Not null, and no component is null, NaN or infinite."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(sound, F.lit(False))


def usable(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """vec_id, vector (doubles): rows with an id and a finite vector; an id that repeats counts once, with its least vector."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    return rows.filter(F.col("vec_id").isNotNull() & finite(F.col("vector"))).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def queries_of(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("vec_id") % QUERY_EVERY == 0).withColumnRenamed("vec_id", "query_id")


def matrix(column: pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Lists of numbers as rows; shorter ones are padded with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy())
    width = max(width or 0, int(lengths.max(initial=0)))
    out = np.zeros((len(lengths), width))
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def best(rows: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of each query, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
