"""A plausible clock for pitches that carry only their game's date, and per-row lateness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dualpath.operators.ordered import HotGroups, OrderedGroups
from dualpath.operators.transitions import game_groups

# First pitch hour and the gaps between pitches, in seconds.
FIRST_PITCH_HOURS = 19
AT_BAT_GAP = 90
PITCH_GAP = 23


def synthesize_event_time(pitches: DataFrame, hot: HotGroups | None = None) -> DataFrame:
    """Replace event_time by game_date 19:00 plus the running sum of gaps in canonical order."""
    groups = game_groups(hot)
    rows = groups.frames(
        groups.split(pitches),
        1,
        lambda w: {
            "_gap": F.when(F.lag("at_bat_number").over(w).isNull(), 0)
            .when(F.lag("at_bat_number").over(w) != F.col("at_bat_number"), AT_BAT_GAP)
            .otherwise(PITCH_GAP)
        },
    )
    rows = groups.running(rows, {"_offset": ("sum", F.col("_gap"))}).merged()
    start = F.col("game_date").cast("timestamp") + F.make_dt_interval(hours=F.lit(FIRST_PITCH_HOURS))
    clock = start + F.make_dt_interval(secs=F.col("_offset"))
    return rows.withColumn("event_time", clock).drop("_gap", "_offset")


def tag_late(df: DataFrame, groups: OrderedGroups, delay_seconds: int = 300) -> DataFrame:
    """Add is_late: the row's clock is more than the delay behind the latest its key has shown so far.

    `groups` must order rows by their position in the source. The flag depends on rows only, not on
    how an engine batched them.
    """
    rows = groups.running(df, {"_latest": ("max", F.unix_micros("event_time"))})
    late = F.unix_micros("event_time") < F.col("_latest") - F.lit(delay_seconds * 1_000_000)
    return rows.withColumn("is_late", late).drop("_latest")
