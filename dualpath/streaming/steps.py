"""Stateful jobs on Spark's own state: live features, alerts, game-state events, late rows, corrections.

Each takes a stream and returns one. What a task carries from batch to batch is in keyed.py; everything else is plain columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dualpath.functions import scores
from dualpath.functions.numbers import MICRO, micros
from dualpath.functions.scores import Composite, Weights
from dualpath.operators.corrections import RECENCY
from dualpath.operators.dedup import newest_per_key
from dualpath.operators.transitions import STATE, transition_rows
from dualpath.plans.features import on_the_edge
from dualpath.plans.marts import USAGE_TYPES
from dualpath.plans.signals import SIGNAL_COLUMNS, STATE_KEY, TRAILING_WIDTH, WARM_UP, alert_rows, in_zone, with_signals
from dualpath.schemas import GAME_STATE, PITCHER_GAME_KEY
from dualpath.streaming.keyed import Running, carry

# Rows of history a live feature may look back on.
TAIL = 20
PACE_WIDTH = 10
ZONE_WIDTH = 15
BASELINE = 20

_TYPES = {t: f"thrown_{t.lower()}" for t in USAGE_TYPES}

LIVE_FEATURES = [
    "velocity_last_20_avg",
    "spin_last_20_avg",
    "pace_last_10_avg",
    "zone_last_15_share",
    "command_last_15_share",
    *_TYPES.values(),
]

LIVE = Running(
    index="pitch_idx",
    windows={
        "speed_20": ("speed", TAIL),
        "spin_20": ("spin", TAIL),
        "zone_15": ("zoned", ZONE_WIDTH),
        "command_15": ("commanded", ZONE_WIDTH),
        "speed_16": ("speed", TRAILING_WIDTH),
        "spin_16": ("spin", TRAILING_WIDTH),
        "zone_16": ("zoned", TRAILING_WIDTH),
    },
    gaps={"pace_10": ("clock", PACE_WIDTH)},
    totals={name: f"is_{t.lower()}" for t, name in _TYPES.items()},
    first={"speed_first": ("speed", BASELINE), "spin_first": ("spin", BASELINE)},
)


def _mean(name: str) -> Column:
    n = F.col(f"{name}_n")
    return F.when(n > 0, F.col(name) / (n * F.lit(float(MICRO))))


def _share(name: str) -> Column:
    return F.col(name) / F.col(f"{name}_n")


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("bigint")


def live_features(pitches: DataFrame, weights: Weights = Weights(), mix: Composite = Composite()) -> DataFrame:
    """Features and signals of each arriving pitch, duplicates left out, from its key's last rows and counters.

    Rows that arrive in one micro-batch are ordered by at-bat and pitch, late copies after the pitch itself.
    """
    fresh = pitches.where(~F.col("is_duplicate")).select(
        *STATE_KEY,
        "is_late_arrival",
        F.unix_micros("event_time").alias("clock"),
        F.unix_micros("ingest_time").alias("ingested"),
        F.col("source_offset").alias("place"),
        micros(F.col("release_speed")).alias("speed"),
        micros(F.col("release_spin_rate")).alias("spin"),
        _flag(in_zone(F.col("zone"))).alias("zoned"),
        _flag(in_zone(F.col("zone")) | on_the_edge(F.col("plate_x"), F.col("plate_z"))).alias("commanded"),
        *[_flag(F.col("pitch_type") == t).alias(source) for t, source in zip(_TYPES, LIVE.totals.values())],
    )
    order = [F.col("at_bat_number"), F.col("pitch_number"), F.col("is_late_arrival").cast("int"), F.col("place")]
    rows = carry(fresh, PITCHER_GAME_KEY, order, LIVE).select(
        *STATE_KEY,
        "is_late_arrival",
        F.timestamp_micros("clock").alias("event_time"),
        F.timestamp_micros("ingested").alias("ingest_time"),
        "pitch_idx",
        _mean("speed_20").alias("velocity_last_20_avg"),
        _mean("spin_20").alias("spin_last_20_avg"),
        _mean("pace_10").alias("pace_last_10_avg"),
        _share("zone_15").alias("zone_last_15_share"),
        _share("command_15").alias("command_last_15_share"),
        *_TYPES.values(),
        _mean("speed_16").alias("velocity_mean"),
        _mean("spin_16").alias("spin_mean"),
        _share("zone_16").alias("zone_share"),
        _mean("speed_first").alias("velocity_baseline"),
        _mean("spin_first").alias("spin_baseline"),
    )
    return with_signals(rows, weights, mix).select(
        *STATE_KEY, "is_late_arrival", "event_time", "ingest_time", "pitch_idx", *LIVE_FEATURES, *SIGNAL_COLUMNS
    )


def rising(scored: DataFrame, weights: Weights = Weights()) -> DataFrame:
    """Alerts where the score of a stream of (state key, pitch_idx, score and signals) rises into a higher band."""
    kept = [*STATE_KEY, "pitch_idx", "score", "fatigue", "leverage", "matchup_edge"]
    severity = scores.severity(F.col("score"))
    rows = scored.select(
        *kept,
        F.unix_micros("event_time").alias("clock"),
        F.unix_micros("ingest_time").alias("ingested"),
        severity.alias("severity"),
        scores.severity_rank(severity).cast("bigint").alias("level"),
    )
    seen = carry(rows, PITCHER_GAME_KEY, [F.col("pitch_idx")], Running(previous={"level_before": "level"}))
    risen = seen.where(F.col("level") > F.coalesce("level_before", F.lit(0)))
    timed = risen.withColumns({"event_time": F.timestamp_micros("clock"), "ingest_time": F.timestamp_micros("ingested")})
    return alert_rows(timed, weights)


def live_alerts(features: DataFrame, weights: Weights = Weights()) -> DataFrame:
    """Alerts from the stream of live features: on-time pitches from the warm-up on."""
    counted = features.where(~F.col("is_late_arrival") & (F.col("pitch_idx") >= WARM_UP))
    return rising(counted.withColumn("score", F.col("composite")), weights)


def game_states(pitches: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """Game-state events, comparing each pitch with the last one its game has shown."""
    when = F.current_timestamp() if ingest_time is None else ingest_time
    own = ["game_pk", "at_bat_number", "pitch_number", *STATE]
    rest = [f.name for f in GAME_STATE if f.name in pitches.columns and f.name not in (*own, "event_time", "ingest_time")]
    rows = pitches.withColumn("ingest_time", when).select(
        *own, *rest, *([] if "batter_id" in rest else ["batter_id"]),
        F.unix_micros("event_time").alias("clock"), F.unix_micros("ingest_time").alias("ingested"),
    )
    order = [F.col("inning"), F.when(F.col("inning_topbot") == "Top", 0).otherwise(1), F.col("at_bat_number"), F.col("pitch_number")]
    spec = Running(index="nth", previous={f"{c}_before": c for c in STATE})
    previous = F.when(F.col("nth") > 1, F.struct(*[F.col(f"{c}_before").alias(c) for c in STATE]))
    seen = carry(rows, ["game_pk"], order, spec).withColumns(
        {"previous": previous, "event_time": F.timestamp_micros("clock"), "ingest_time": F.timestamp_micros("ingested")}
    )
    return transition_rows(seen, F.col("ingest_time")).select(*[f.name for f in GAME_STATE])


_POSITION = ["kafka_partition", "source_offset", "is_late_arrival", "is_duplicate"]


def tagged_late(pitches: DataFrame, delay_seconds: int = 300) -> DataFrame:
    """Position rows with is_late: the clock is more than the delay behind the latest that the key has shown so far."""
    rows = pitches.select(*PITCHER_GAME_KEY, F.unix_micros("event_time").alias("clock"), *_POSITION)
    order = [F.col(c).cast("double") for c in _POSITION]
    seen = carry(rows, PITCHER_GAME_KEY, order, Running(highest={"latest": "clock"}))
    late = F.col("clock") < F.col("latest") - F.lit(delay_seconds * MICRO)
    return seen.select(*PITCHER_GAME_KEY, F.timestamp_micros("clock").alias("event_time"), *_POSITION, late.alias("is_late"))


def newest_changes(batch: DataFrame) -> DataFrame:
    """The newest change per (pitch, field): of a batch for the change log, and of the log as it reads now."""
    return newest_per_key(batch, ["original_pitch_uid", "field"], [F.desc_nulls_last(c) for c in RECENCY])
