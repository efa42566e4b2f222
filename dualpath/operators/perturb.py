"""Copies and corrections added to a clean pitch table, the same on every run and partitioning.

All draws come from a digest of the pitch id, so a row's fate never depends on its neighbours.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dualpath.functions.events import event_kind, pitch_uid, shift_minutes, shift_seconds
from dualpath.schemas import CORRECTION

# Pitch types that are mistaken for each other.
CONFUSED_WITH = {
    "FF": ["FT", "SI"],
    "FT": ["FF", "SI"],
    "SI": ["FT", "FF"],
    "SL": ["CU", "FC"],
    "CU": ["SL", "KC"],
    "KC": ["CU"],
    "CH": ["FS"],
    "FS": ["CH"],
}

# Bounds of the shifts.
LATE_SECONDS = (30, 300)
CORRECTION_MINUTES = (5, 45)


@dataclass(frozen=True)
class Rates:
    # Default shares of pitches hit.
    late: float = 0.03
    duplicate: float = 0.005
    correction: float = 0.01


def _word(seed: int, tag: str, at: int) -> Column:
    """32 bits of the pitch's digest as BIGINT."""
    digest = F.md5(F.concat(pitch_uid(), F.lit(f"|{seed}|{tag}")).cast("binary"))
    return F.conv(F.substring(digest, 8 * at + 1, 8), 16, 10).cast("bigint")


def _hit(seed: int, at: int, rate: float) -> Column:
    return _word(seed, "draw", at) < F.lit(round(rate * 2**32))


def _between(seed: int, at: int, bounds: tuple[int, int]) -> Column:
    low, high = bounds
    return _word(seed, "amount", at) % F.lit(high - low + 1) + F.lit(low)


def with_copies(pitches: DataFrame, rates: Rates = Rates(), seed: int = 0) -> DataFrame:
    """Each pitch, then its flagged duplicate if drawn, then its late copy if drawn."""
    copies = F.filter(
        F.array(
            F.lit("original"),
            F.when(_hit(seed, 0, rates.duplicate), "duplicate"),
            F.when(_hit(seed, 1, rates.late), "late"),
        ),
        lambda c: c.isNotNull(),
    )
    late = F.col("_copy") == "late"
    early = shift_seconds(F.col("event_time"), -_between(seed, 0, LATE_SECONDS))
    return (
        pitches.withColumn("_copy", F.explode(copies))
        .withColumns(
            {
                "event_time": F.when(late, early).otherwise(F.col("event_time")),
                "is_late_arrival": F.col("is_late_arrival") | late,
                "is_duplicate": F.col("is_duplicate") | (F.col("_copy") == "duplicate"),
            }
        )
        .select(*pitches.columns)
    )


def flipped_type(seed: int) -> Column:
    """A type the pitch could be mistaken for, or NULL when there is none."""
    table = F.create_map(
        *[x for k, v in CONFUSED_WITH.items() for x in (F.lit(k), F.array(*[F.lit(t) for t in v]))]
    )
    choices = F.try_element_at(table, F.col("pitch_type"))
    return F.get(choices, (_word(seed, "amount", 1) % F.size(choices)).cast("int"))


def drawn_corrections(pitches: DataFrame, rates: Rates = Rates(), seed: int = 0) -> DataFrame:
    """Corrections of the pitch type, minutes after the pitch; none where no confusion is known."""
    hit = pitches.where(F.col("pitch_type").isNotNull() & _hit(seed, 2, rates.correction))
    return (
        hit.withColumns(
            {
                "original_pitch_uid": pitch_uid(),
                "field": F.lit("pitch_type"),
                "old_value": F.col("pitch_type"),
                "new_value": flipped_type(seed),
                "_event": shift_minutes(F.col("event_time"), _between(seed, 2, CORRECTION_MINUTES)),
                "_ingest": shift_minutes(F.col("ingest_time"), _between(seed, 3, CORRECTION_MINUTES)),
            }
        )
        .where(F.col("new_value").isNotNull())
        .withColumns({"event_time": F.col("_event"), "ingest_time": F.col("_ingest")})
        .select(*[f.name for f in CORRECTION])
    )


def kind_counts(pitches: DataFrame, corrections: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """Events by kind: pitch, duplicate, late, correction and, when given, game_state."""
    seen = pitches.select("is_duplicate", "is_late_arrival", F.lit(False).alias("is_correction"))
    fixed = corrections.select(
        F.lit(False).alias("is_duplicate"),
        F.lit(False).alias("is_late_arrival"),
        F.lit(True).alias("is_correction"),
    )
    kinds = seen.unionByName(fixed).select(event_kind().alias("kind"))
    if states is not None:
        kinds = kinds.unionByName(states.select(F.lit("game_state").alias("kind")))
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
