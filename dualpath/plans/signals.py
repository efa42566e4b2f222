"""Signals per pitch, as the stream sees them and as the corrected batch does, and alerts from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dualpath.functions import scores
from dualpath.functions.numbers import MICRO, frame_mean, micros, rounded, share
from dualpath.functions.scores import Composite, Weights
from dualpath.operators.ordered import HotGroups
from dualpath.plans.features import BASELINE_PITCHES, pitcher_groups
from dualpath.plans.staging import arrivals_by_game
from dualpath.schemas import ALERT, PITCHER_GAME_KEY

# The trailing window and the pitch from which signals are emitted.
TRAILING_WIDTH = 16
WARM_UP = 20

STATE_KEY = [*PITCHER_GAME_KEY, "at_bat_number", "pitch_number"]


def load_weights(spark: SparkSession, path: str) -> Weights:
    """The pinned calibration artifact: a Parquet table of one row."""
    row = spark.read.parquet(path).first()
    return Weights(**row.asDict())


def save_weights(spark: SparkSession, weights: Weights, path: str) -> None:
    spark.createDataFrame([weights.__dict__]).coalesce(1).write.mode("overwrite").parquet(path)


def in_zone(zone: Column) -> Column:
    return zone <= 9


def _trailing(w, width: int) -> dict[str, Column]:
    frame = w.rowsBetween(1 - width, 0)
    return {
        "velocity_mean": frame_mean(F.col("release_speed"), frame),
        "spin_mean": frame_mean(F.col("release_spin_rate"), frame),
        "zone_share": share(in_zone(F.col("zone")), frame),
    }


_READ = ["event_time", "ingest_time", *STATE_KEY, "release_speed", "release_spin_rate", "zone"]
_KEEP = [
    "event_time",
    "ingest_time",
    *STATE_KEY,
    "pitch_idx",
    "velocity_mean",
    "spin_mean",
    "zone_share",
    "velocity_baseline",
    "spin_baseline",
]


def canonical_features(
    staged: DataFrame, hot: HotGroups | None = None, width: int = TRAILING_WIDTH
) -> DataFrame:
    """Trailing means over deduplicated, corrected pitches, against the whole first-20 baseline."""
    groups = pitcher_groups(hot)
    rows = groups.running(groups.split(staged.select(*_READ)), {"pitch_idx": ("count", None)})
    rows = groups.frames(rows, width - 1, lambda w: _trailing(w, width))
    rows = groups.means_of(
        rows,
        {"velocity_baseline": F.col("release_speed"), "spin_baseline": F.col("release_spin_rate")},
        F.col("pitch_idx") <= BASELINE_PITCHES,
    )
    return rows.merged().select(*_KEEP)


def provisional_features(
    bronze: DataFrame, hot: HotGroups | None = None, width: int = TRAILING_WIDTH
) -> DataFrame:
    """The same as a stream computes it on arrival: late copies count, nothing is corrected, and the
    baseline knows only the pitches so far. One row per on-time pitch."""
    groups = pitcher_groups(hot, F.asc_nulls_last("is_late_arrival"), F.asc_nulls_last("source_offset"))
    rows = arrivals_by_game(bronze).select(*_READ, "is_late_arrival", "source_offset")
    rows = groups.running(groups.split(rows), {"pitch_idx": ("count", None)})
    rows = groups.frames(rows, width - 1, lambda w: _trailing(w, width))
    early = F.col("pitch_idx") <= BASELINE_PITCHES
    speed, spin = (F.when(early, micros(F.col(c))) for c in ("release_speed", "release_spin_rate"))
    one = F.lit(1)
    rows = groups.running(
        rows,
        {
            "_v": ("sum", speed),
            "_vn": ("sum", F.when(speed.isNotNull(), one)),
            "_s": ("sum", spin),
            "_sn": ("sum", F.when(spin.isNotNull(), one)),
        },
    )
    unit = F.lit(float(MICRO))
    return (
        rows.merged().where(~F.col("is_late_arrival"))
        .withColumns(
            {
                "velocity_baseline": F.col("_v") / (F.col("_vn") * unit),
                "spin_baseline": F.col("_s") / (F.col("_sn") * unit),
            }
        )
        .select(*_KEEP)
    )


SIGNAL_COLUMNS = [
    "fatigue",
    "fatigue_velocity_component",
    "fatigue_spin_component",
    "fatigue_command_component",
    "leverage",
    "matchup_edge",
    "composite",
]


def with_signals(
    features: DataFrame, weights: Weights = Weights(), mix: Composite = Composite()
) -> DataFrame:
    """Add fatigue with its components, leverage, matchup edge and their composite."""
    idx = F.col("pitch_idx")
    velocity = scores.velocity_component(F.col("velocity_mean"), F.col("velocity_baseline"))
    spin = scores.spin_component(F.col("spin_mean"), F.col("spin_baseline"))
    raw = features.withColumns(
        {"_fv": velocity, "_fs": spin, "_fc": scores.command_component(F.col("zone_share"))}
    ).withColumn(
        "_f",
        scores.fatigue_score(
            F.col("_fv"), F.col("_fs"), F.col("_fc"), scores.pitch_count_component(idx), weights
        ),
    )
    signals = raw.withColumns(
        {
            "fatigue": rounded(F.col("_f"), 3),
            "fatigue_velocity_component": rounded(F.col("_fv"), 3),
            "fatigue_spin_component": rounded(F.col("_fs"), 3),
            "fatigue_command_component": rounded(F.col("_fc"), 3),
            "leverage": rounded(scores.leverage_by_pitch(idx), 2),
            "matchup_edge": rounded(scores.matchup_from_fatigue(F.col("_f")), 3),
        }
    ).drop("_f", "_fv", "_fs", "_fc")
    composite = scores.composite_score(F.col("fatigue"), F.col("leverage"), F.col("matchup_edge"), mix)
    return signals.withColumn("composite", composite)


def signal_snapshots(
    features: DataFrame, weights: Weights = Weights(), mix: Composite = Composite(), warm_up: int = WARM_UP
) -> DataFrame:
    """Signals of each pitch from the warm-up on."""
    return with_signals(features.where(F.col("pitch_idx") >= warm_up), weights, mix).select(
        "event_time", "ingest_time", *STATE_KEY, "pitch_idx", *SIGNAL_COLUMNS
    )


def display_rows(snapshots: DataFrame, features: DataFrame) -> DataFrame:
    """Values the dashboard shows beside the signals."""
    first = F.min("event_time").alias("first_pitch")
    starts = features.groupBy("game_pk").agg(first)
    idx = F.col("pitch_idx")
    return snapshots.join(starts, "game_pk").select(
        *STATE_KEY,
        "pitch_idx",
        F.date_format("event_time", "HH:mm:ss 'UTC'").alias("clock"),
        scores.scheduled_time(F.col("first_pitch"), idx).alias("scheduled_time"),
        *[c.alias(n) for n, c in scores.scheduled_position(idx).items()],
        (F.col("leverage") / scores.LEVERAGE_DISPLAY_SCALE).alias("leverage_scaled"),
        scores.canonical_shift(F.col("fatigue"), idx).alias("fatigue_shifted"),
    )


def velocity_line(staged: DataFrame, hot: HotGroups | None = None, width: int = 10) -> DataFrame:
    """Each pitch's speed with its trailing mean; the first rows use what is there."""
    rows = staged.select(*STATE_KEY, "release_speed")
    return pitcher_groups(hot).frames(
        rows,
        width - 1,
        lambda w: {"velocity_rolling": frame_mean(F.col("release_speed"), w.rowsBetween(1 - width, 0))},
    )


def changes_only(snapshots: DataFrame, column: str, hot: HotGroups | None = None, keep: list[str] | None = None) -> DataFrame:
    """A signal as its own stream: one row when its value changes, with the columns `keep`."""
    rows = pitcher_groups(hot).frames(
        snapshots.select(*STATE_KEY, column, *(keep or [])), 1, lambda w: {"_was": F.lag(column).over(w)}
    )
    return rows.where(F.col("_was").isNull() | (F.col("_was") != F.col(column))).drop("_was")


def align_signals(
    fatigue: DataFrame, leverage: DataFrame, matchup: DataFrame, hot: HotGroups | None = None
) -> DataFrame:
    """Each fatigue row with the latest leverage and matchup known at that state."""
    rows = (
        leverage.withColumn("_kind", F.lit(0))
        .unionByName(matchup.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
        .unionByName(fatigue.withColumn("_kind", F.lit(2)), allowMissingColumns=True)
    )
    aligned = pitcher_groups(hot, F.asc("_kind")).running(
        rows,
        {
            "latest_leverage": ("last", F.col("leverage")),
            "latest_matchup": ("last", F.col("matchup_edge")),
        },
    )
    return aligned.where(F.col("_kind") == 2).select(
        *fatigue.columns,
        F.col("latest_leverage").alias("leverage"),
        F.col("latest_matchup").alias("matchup_edge"),
    )


def orchestrate(
    aligned: DataFrame,
    hot: HotGroups | None = None,
    mix: Composite = Composite(),
    weights: Weights = Weights(),
) -> DataFrame:
    """An alert wherever the composite rises into a higher band, with its model version."""
    score = scores.composite_score(F.col("fatigue"), F.col("leverage"), F.col("matchup_edge"), mix)
    rows = with_rises(aligned.withColumn("score", score), hot)
    return alert_rows(rows.where(F.col("rises")), weights)


def with_rises(scored: DataFrame, hot: HotGroups | None = None) -> DataFrame:
    """Add the severity of the score and whether it rose above the pitcher's previous state."""
    rows = scored.withColumn("severity", scores.severity(F.col("score")))
    rows = rows.withColumn("_rank", scores.severity_rank(F.col("severity")))
    return (
        pitcher_groups(hot)
        .frames(rows, 1, lambda w: {"_before": F.coalesce(F.lag("_rank").over(w), F.lit(0))})
        .withColumn("rises", F.col("_rank") > F.col("_before"))
        .drop("_rank", "_before")
    )


def alert_uid() -> Column:
    return F.concat_ws("-", *[F.col(c).cast("string") for c in STATE_KEY], "severity")


def alert_rows(rows: DataFrame, weights: Weights) -> DataFrame:
    """Alert columns for rows that carry a score, its severity and the signals behind it."""
    keys = [F.col(c).cast("string") for c in STATE_KEY]
    alerts = rows.withColumns(
        {
            "emitted_time": F.col("ingest_time"),
            "alert_uid": alert_uid(),
            "signal_type": F.lit("composite"),
            "score_threshold": scores.band_floor(F.col("severity")),
            "rationale": F.concat(F.lit("composite reached "), F.col("severity")),
            "inputs_snapshot_uid": F.concat_ws(":", F.lit("snap"), *keys),
            "model_version": F.lit(weights.model_version),
        }
    )
    return alerts.select(
        *[f.name for f in ALERT],
        "model_version",
        "at_bat_number",
        "pitch_number",
        "fatigue",
        "leverage",
        "matchup_edge",
    )


def latest_alert(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy(F.desc("emitted_time"), F.desc("alert_uid")).limit(1)


def snapshot_at(snapshots: DataFrame, game_pk: int, pitcher_id: int, pitch_idx: int) -> DataFrame:
    return snapshots.where(
        (F.col("game_pk") == game_pk)
        & (F.col("pitcher_id") == pitcher_id)
        & (F.col("pitch_idx") == pitch_idx)
    ).limit(1)
