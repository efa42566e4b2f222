"""Identity, classification and clock expressions on event rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dualpath.schemas import PITCH_KEY


def pitch_uid() -> Column:
    return F.concat_ws(":", *[F.col(c).cast("string") for c in PITCH_KEY])


def event_kind() -> Column:
    """Corrections first, then the duplicate flag, then the late flag."""
    return (
        F.when(F.col("is_correction"), "correction")
        .when(F.col("is_duplicate"), "duplicate")
        .when(F.col("is_late_arrival"), "late")
        .otherwise("pitch")
    )


def from_millis(c: Column) -> Column:
    return F.timestamp_millis(c)


def to_millis(c: Column) -> Column:
    return F.unix_millis(c)


def shift_seconds(ts: Column, seconds: Column) -> Column:
    return ts + F.make_dt_interval(secs=seconds)


def shift_minutes(ts: Column, minutes: Column) -> Column:
    return ts + F.make_dt_interval(mins=minutes)


def class_label(c: Column) -> Column:
    return F.replace(c, F.lit("_"), F.lit(" "))


def pitcher_order_slot() -> Column:
    """BIGINT that rises with (at_bat_number, pitch_number)."""
    return F.col("at_bat_number").cast("bigint") * F.lit(1 << 32) + F.col("pitch_number")


GAME_ORDER = ["inning", "inning_topbot", "at_bat_number", "pitch_number"]


def game_order() -> list[Column]:
    """Canonical order inside a game; Top sorts before Bot."""
    return [
        F.asc_nulls_last("inning"),
        F.desc_nulls_last("inning_topbot"),
        F.asc_nulls_last("at_bat_number"),
        F.asc_nulls_last("pitch_number"),
    ]
