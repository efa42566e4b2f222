"""Late corrections laid over the pitches they name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dualpath.operators.dedup import latest_per_field, newest_per_key
from dualpath.schemas import PITCH, PITCH_KEY

# The columns a correction may change.
CORRECTABLE = [
    "pitch_type",
    "release_speed",
    "release_spin_rate",
    "plate_x",
    "plate_z",
    "zone",
    "description",
    "events",
]

RECENCY = ["ingest_time", "event_time", "new_value"]


def with_pitch_key(corrections: DataFrame) -> DataFrame:
    """Split the pitch uid into the pitch key, so the join reuses the key's partitioning.

    A uid that does not spell its key back the same way names no pitch and is left out.
    """
    parts = F.split("original_pitch_uid", ":")
    typed = corrections.withColumns(
        {
            "_g": F.get(parts, F.lit(0)).try_cast("bigint"),
            "_a": F.get(parts, F.lit(1)).try_cast("int"),
            "_p": F.get(parts, F.lit(2)).try_cast("int"),
        }
    )
    spelled = F.concat(F.col("_g").cast("string"), F.lit(":"), F.col("_a"), F.lit(":"), F.col("_p"))
    return (
        typed.where(spelled == F.col("original_pitch_uid"))
        .drop("game_pk")
        .withColumnsRenamed(dict(zip(["_g", "_a", "_p"], PITCH_KEY)))
    )


def _recency() -> list[Column]:
    return [F.desc_nulls_last(c) for c in RECENCY]


def latest_corrections(corrections: DataFrame) -> DataFrame:
    """Latest correction per (pitch, field)."""
    return newest_per_key(corrections, ["original_pitch_uid", "field"], _recency()).select(
        "original_pitch_uid", "field", "new_value"
    )


def correct_pitch_type(pitches: DataFrame, corrections: DataFrame) -> DataFrame:
    """The latest pitch_type correction wins; a NULL correction keeps the reported type.

    Takes corrections that carry the pitch key. They are aggregated by it, so Spark knows the key is
    unique and drops the join from plans that do not read pitch_type.
    """
    wanted = corrections.where(F.col("field") == "pitch_type")
    latest = latest_per_field(wanted, PITCH_KEY, ["pitch_type"], RECENCY).select(
        *PITCH_KEY, F.col("pitch_type").alias("_fix")
    )
    return (
        pitches.join(latest, PITCH_KEY, "left")
        .withColumn("pitch_type", F.coalesce("_fix", "pitch_type"))
        .drop("_fix")
        .select(*pitches.columns)
    )


def correct_all_fields(
    pitches: DataFrame, corrections: DataFrame, fields: Sequence[str] = CORRECTABLE
) -> DataFrame:
    """The same rule for every correctable column; text that does not parse keeps the reported value."""
    wanted = corrections.where(F.col("field").isin(*fields))
    latest = latest_per_field(wanted, PITCH_KEY, fields, RECENCY)
    latest = latest.withColumnsRenamed({f: f"_fix_{f}" for f in fields})
    types = {f.name: f.dataType.simpleString() for f in PITCH}
    return (
        pitches.join(latest, PITCH_KEY, "left")
        .withColumns({f: F.coalesce(F.col(f"_fix_{f}").try_cast(types[f]), F.col(f)) for f in fields})
        .select(*pitches.columns)
    )
