"""Raw pitch rows: typed, ordered, and cut to a day, a game or a first few."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dualpath.functions import cleaning
from dualpath.functions.events import game_order
from dualpath.schemas import PITCH

# Raw names that differ from ours, and the value of a column that is absent.
RAW_NAMES = {"pitcher_id": "pitcher", "batter_id": "batter"}
ABSENT = {"home_score": 0, "away_score": 0, "is_late_arrival": False, "is_duplicate": False}

_READERS = {
    T.DoubleType(): cleaning.lenient_double,
    T.IntegerType(): cleaning.lenient_int,
    T.LongType(): cleaning.lenient_long,
    T.StringType(): cleaning.clean_text,
}


def load_day(spark: SparkSession, path: str, day: datetime.date) -> DataFrame:
    """One day of raw pitches; the day reaches the scan as a pushed filter."""
    return spark.read.parquet(path).where(F.col("game_date") == F.lit(day))


def typed_pitches(raw: DataFrame) -> DataFrame:
    """Raw columns renamed, read leniently and defaulted, in one projection.

    A required value that cannot be read is NULL here; quarantine_split sets such rows aside.
    """
    out = []
    for f in PITCH:
        source = RAW_NAMES.get(f.name, f.name)
        if source not in raw.columns:
            value = F.lit(ABSENT.get(f.name)).cast(f.dataType)
        elif f.name == "inning_topbot":
            value = cleaning.half_inning(F.col(source))
        elif f.dataType in _READERS:
            value = _READERS[f.dataType](F.col(source))
        else:
            value = F.col(source).cast(f.dataType)
        out.append(value.alias(f.name))
    return raw.select(*out)


def canonical_order(pitches: DataFrame) -> DataFrame:
    return pitches.orderBy("game_pk", *game_order())


def first_pitches(pitches: DataFrame, n: int) -> DataFrame:
    """First n rows in canonical order; each task keeps its own n."""
    return canonical_order(pitches).limit(n)


def one_game(pitches: DataFrame, game_pk: int) -> DataFrame:
    return pitches.where(F.col("game_pk") == game_pk)


def games(pitches: DataFrame) -> DataFrame:
    return pitches.select("game_pk").distinct().orderBy("game_pk")


def time_bounds(pitches: DataFrame) -> DataFrame:
    """Rows, games, first and last event time."""
    return pitches.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("game_pk").alias("games"),
        F.min("event_time").alias("first_event_time"),
        F.max("event_time").alias("last_event_time"),
    )
