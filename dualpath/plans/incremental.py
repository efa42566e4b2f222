"""Keep the rolling features current by recomputing the games that new rows touch, and only those."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dualpath.operators.corrections import with_pitch_key
from dualpath.plans.features import hot_pitchers, pitcher_game_window
from dualpath.plans.staging import staged_pitches_all_fields
from dualpath.session import written
from dualpath.sources.lake import SNAPSHOT, Lake

GAMES_PER_PART = 1000

WINDOW_TABLE = T.StructType(
    [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("game_pk", T.LongType()),
        T.StructField("pitcher_id", T.LongType()),
        T.StructField("at_bat_number", T.IntegerType()),
        T.StructField("pitch_number", T.IntegerType()),
        T.StructField("pitches_thrown_so_far", T.LongType()),
        T.StructField("velocity_last_20_avg", T.DoubleType()),
        T.StructField("spin_last_20_avg", T.DoubleType()),
        T.StructField("velocity_first_20_avg", T.DoubleType()),
        T.StructField("spin_first_20_avg", T.DoubleType()),
        T.StructField("game_part", T.LongType()),
    ]
)


def ensure_window_table(lake: Lake, target: str) -> None:
    """Partitioned by runs of game ids: a game never moves, and games close in time lie together."""
    lake.ensure_table(target, WINDOW_TABLE, ["game_part"])


def refresh(
    lake: Lake,
    bronze: str,
    corrections: str,
    target: str,
    after: int | None,
    games_per_part: int = GAMES_PER_PART,
) -> None:
    """Bring the target up to the last commits, given the commit it was last built from.

    A high-water mark on event_time would miss late rows and cut each pitcher's history, so the
    games of all new rows and new corrections are recomputed whole. The other games of the touched
    partitions are copied as they are.
    """
    part = F.floor(F.col("game_pk") / games_per_part).cast("bigint")
    all_pitches, all_fixes = lake.read(bronze), lake.read(corrections)
    if after is None:
        _write(lake, target, _windows(all_pitches, all_fixes).withColumn("game_part", part))
        return

    fresh = all_pitches.where(F.col(SNAPSHOT) > after)
    fresh_fixes = with_pitch_key(all_fixes.where(F.col(SNAPSHOT) > after))
    changed = fresh.select("game_pk").unionByName(fresh_fixes.select("game_pk")).distinct()
    changed = written(changed, "changed-games")
    touched = changed.select(part.alias("game_part")).distinct()
    old = lake.read_plain(target).join(touched, "game_part", "left_semi")

    # The days the changed games were played on, as a filter on the partitions; at most a calendar of
    # them. A dropped older copy on another day cannot win the dedup.
    days = (
        old.join(changed, "game_pk", "left_semi")
        .select(F.to_date("event_time").alias("d"))
        .unionByName(fresh.select(F.col("event_day").alias("d")))
        .distinct()
        .collect()
    )
    known = [r["d"] for r in days if r["d"] is not None]
    unknown = F.col("event_day").isNull() if len(known) < len(days) else F.lit(False)
    pitches = all_pitches.where(F.col("event_day").isin(known) | unknown)
    pitches = pitches.join(changed, "game_pk", "left_semi")
    named = with_pitch_key(all_fixes).select("game_pk", "original_pitch_uid")
    wanted = named.join(changed, "game_pk", "left_semi").select("original_pitch_uid").distinct()
    fixes = all_fixes.join(wanted, "original_pitch_uid", "left_semi")

    rebuilt = _windows(pitches, fixes).withColumn("game_part", part)
    kept = old.join(changed, "game_pk", "left_anti")
    _write(lake, target, rebuilt.unionByName(kept.select(*rebuilt.columns)))


def _windows(pitches: DataFrame, fixes: DataFrame) -> DataFrame:
    return pitcher_game_window(staged_pitches_all_fields(pitches, fixes), hot_pitchers(pitches))


def _write(lake: Lake, target: str, rows: DataFrame) -> None:
    lake.overwrite_partitions(rows, target, "game_part")
