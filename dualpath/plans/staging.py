"""Canonical pitches: duplicates out, newest report kept, corrections applied."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dualpath.functions.events import pitch_uid
from dualpath.operators.corrections import (
    correct_all_fields,
    correct_pitch_type,
    with_pitch_key,
)
from dualpath.operators.dedup import newest_per_key, pitch_recency
from dualpath.operators.ordered import find_hot_groups
from dualpath.schemas import BRONZE_PITCH, PITCH, PITCH_KEY
from dualpath.session import CO_PARTITION

STAGED = [f.name for f in PITCH if f.name not in ("is_late_arrival", "is_duplicate", "correction_of")]


def drop_flagged(pitches: DataFrame) -> DataFrame:
    """Rows flagged as duplicates go, and so does a NULL flag."""
    return pitches.where(~F.col("is_duplicate"))


def by_game(bronze: DataFrame, corrections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Partition both inputs by game, unless a game is too big for one task.

    Dedup, the correction join and every per-game or per-pitcher window then run on this one
    shuffle, because game_pk is part of all their keys.
    """
    corrections = with_pitch_key(corrections)
    if (
        not _fits_by_game(bronze)
        or find_hot_groups(corrections, ["game_pk"]) is not None
    ):
        return bronze, corrections
    return bronze.repartition("game_pk"), corrections.repartition("game_pk")


def arrivals_by_game(bronze: DataFrame) -> DataFrame:
    """Rows not flagged as duplicates, laid out like the canonical side, so the two join in place."""
    rows = drop_flagged(bronze)
    return rows.repartition("game_pk") if _fits_by_game(bronze) else rows


def _fits_by_game(rows: DataFrame) -> bool:
    if rows.sparkSession.conf.get(CO_PARTITION) == "true":
        return False
    return find_hot_groups(rows, ["game_pk"]) is None


def deduplicated(bronze: DataFrame) -> DataFrame:
    return newest_per_key(drop_flagged(bronze), PITCH_KEY, pitch_recency())


def staged_pitches(bronze: DataFrame, corrections: DataFrame) -> DataFrame:
    """One row per canonical pitch, pitch_type corrected."""
    bronze, corrections = by_game(bronze, corrections)
    return correct_pitch_type(deduplicated(bronze), corrections).select(*STAGED)


def staged_pitches_all_fields(bronze: DataFrame, corrections: DataFrame) -> DataFrame:
    """One row per canonical pitch, every correctable field corrected."""
    bronze, corrections = by_game(bronze, corrections)
    return correct_all_fields(deduplicated(bronze), corrections).select(*STAGED)


def silver_pitch_events(bronze: DataFrame) -> DataFrame:
    """Every bronze row with its pitch id and day; nothing is filtered."""
    columns = [f.name for f in BRONZE_PITCH if f.name in bronze.columns]
    return bronze.select(
        pitch_uid().alias("pitch_id"), *columns, F.to_date("event_time").alias("event_day")
    )
