"""Season dimensions, canonical facts, and the label and fit of the fatigue weights."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dualpath.functions.numbers import group_mean
from dualpath.functions.scores import Weights
from dualpath.operators.ordered import HotGroups, OrderedGroups

# Pitch types reported in the usage columns.
USAGE_TYPES = ["FF", "SL", "CH", "CU", "SI", "FC", "KC", "FT", "FS"]

COMPONENTS = [
    "fatigue_velocity_component",
    "fatigue_spin_component",
    "fatigue_command_component",
    "pitch_count_component",
]


def _usage() -> list[Column]:
    n = F.count("pitch_type")
    return [(F.count_if(F.col("pitch_type") == t) / n).alias(f"usage_{t.lower()}") for t in USAGE_TYPES]


def pitcher_season(pitches: DataFrame) -> DataFrame:
    """Season baselines of a pitcher: volume, speed, spin and pitch mix."""
    return (
        pitches.withColumn("season", F.year("event_time"))
        .groupBy("pitcher_id", "season")
        .agg(
            F.count(F.lit(1)).alias("pitches"),
            F.countDistinct("game_pk").alias("games"),
            group_mean(F.col("release_speed")).alias("season_velocity"),
            group_mean(F.col("release_spin_rate")).alias("season_spin"),
            *_usage(),
        )
    )


def batter_season(pitches: DataFrame) -> DataFrame:
    """Season splits of a batter by hand and pitch type."""
    return (
        pitches.withColumn("season", F.year("event_time"))
        .groupBy("batter_id", "season", "batter_hand", "pitch_type")
        .agg(
            F.count(F.lit(1)).alias("pitches"),
            F.count("events").alias("outcomes"),
            group_mean(F.col("release_speed")).alias("mean_speed_faced"),
        )
    )


def canonical_pitches(staged: DataFrame, pitchers: DataFrame) -> DataFrame:
    """One row per canonical pitch with its pitcher's season baselines.

    The dimension holds one row per pitcher and season, so the join never fans out.
    """
    seasoned = staged.withColumn("season", F.year("event_time"))
    context = pitchers.select("pitcher_id", "season", "season_velocity", "season_spin")
    return seasoned.join(context, ["pitcher_id", "season"], "left").withColumn(
        "velocity_vs_season", F.col("release_speed") - F.col("season_velocity")
    )


def with_batter_context(pitches: DataFrame, batters: DataFrame) -> DataFrame:
    """One row per canonical pitch with its batter's season against that hand and pitch type.

    The dimension holds one row per key, a missing pitch type included, so the join never fans out.
    """
    key = ["batter_id", "season", "batter_hand", "pitch_type"]
    context = batters.select(
        *[F.col(c).alias(f"_{c}") for c in key],
        F.col("pitches").alias("batter_pitches_seen"),
        F.col("mean_speed_faced").alias("batter_mean_speed_faced"),
    )
    match = F.lit(True)
    for c in key:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    seasoned = pitches.withColumn("season", F.year("event_time"))
    return seasoned.join(context, match, "left").drop(*[f"_{c}" for c in key])


def removal_label(pitches: DataFrame, hot: HotGroups | None = None) -> DataFrame:
    """Per at-bat: was the pitcher gone within the next two batters the team faced?

    Read backwards through the half-innings a side fields, so "next" is a bounded look-back frame.
    At-bats without two followers count what they have.
    """
    at_bats = pitches.groupBy("game_pk", "inning_topbot", "at_bat_number").agg(
        F.max_by("pitcher_id", F.struct("pitch_number", "event_time", "pitcher_id")).alias("pitcher_id")
    )
    groups = OrderedGroups(("game_pk", "inning_topbot"), (F.desc_nulls_last("at_bat_number"),), hot)
    rows = groups.frames(
        at_bats,
        2,
        lambda w: {"_next": F.lag("pitcher_id", 1).over(w), "_second": F.lag("pitcher_id", 2).over(w)},
    )
    gone = (F.col("_next") != F.col("pitcher_id")) | (F.col("_second") != F.col("pitcher_id"))
    return rows.withColumn("removed_soon", F.coalesce(gone, F.lit(False))).drop("_next", "_second")


def training_rows(snapshots: DataFrame, labels: DataFrame) -> DataFrame:
    """Components of each state with the observed removal label of its at-bat."""
    label = labels.select("game_pk", "at_bat_number", "pitcher_id", F.col("removed_soon").cast("double").alias("label"))
    count = F.least(F.lit(1.0), F.col("pitch_idx") / F.lit(110.0))
    return (
        snapshots.withColumn("pitch_count_component", count)
        .join(label, ["game_pk", "at_bat_number", "pitcher_id"])
        .select(*[F.coalesce(c, F.lit(0.0)).alias(c) for c in COMPONENTS], "label")
    )


# Newton steps from zero, and the ridge a row that keeps them stable where a component never varies.
ROUNDS = 8
RIDGE = 0.01


@dataclass(frozen=True)
class Calibration:
    """A logistic fit: the intercept, a coefficient per component, and the rows it saw."""

    intercept: float
    coefficients: tuple[float, ...]
    rows: int

    @property
    def negative(self) -> list[str]:
        """Components whose fit says that they work the other way: they get no weight."""
        return [name for name, c in zip(COMPONENTS, self.coefficients) if c < 0]

    def shares(self) -> list[float] | None:
        """The positive coefficients scaled to sum to one; None where no component helps."""
        positive = [max(0.0, c) for c in self.coefficients]
        total = sum(positive)
        return [c / total for c in positive] if total else None


def calibrate(rows: DataFrame, rounds: int = ROUNDS, ridge: float = RIDGE) -> Calibration:
    """Fit the label to the components by iteratively reweighted least squares.

    Each round is one aggregation of the Gram sums over all rows; what comes back is five by five. The intercept has no ridge.
    `rows` is read once a round, so give it as a table. Without rows, or with labels all alike, the fit is all zeros.
    """
    x = [F.lit(1.0), *[F.col(c) for c in COMPONENTS]]
    size = len(x)
    pairs = [(i, j) for i in range(size) for j in range(i + 1)]
    w = np.zeros(size)
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).first()
    if not total["n"] or total["low"] == total["high"]:
        return Calibration(0.0, (0.0,) * len(COMPONENTS), total["n"])
    penalty = ridge * total["n"] * np.diag([0.0, *[1.0] * len(COMPONENTS)])
    for _ in range(rounds):
        z = sum((c * F.lit(float(b)) for c, b in zip(x, w)), F.lit(0.0))
        p = 1 / (1 + F.exp(-z))
        part = rows.select(*[c.alias(f"x{i}") for i, c in enumerate(x)], p.alias("p"), "label")
        part = part.withColumns({"v": F.col("p") * (1 - F.col("p")), "e": F.col("label") - F.col("p")})
        gram = [F.sum(F.col("v") * F.col(f"x{i}") * F.col(f"x{j}")) for i, j in pairs]
        sums = part.agg(*gram, *[F.sum(F.col("e") * F.col(f"x{i}")) for i in range(size)]).first()
        h = np.zeros((size, size))
        for (i, j), value in zip(pairs, sums):
            h[i, j] = h[j, i] = value
        w = w + np.linalg.solve(h + penalty, np.array(sums[len(pairs) :]) - penalty @ w)
    return Calibration(float(w[0]), tuple(float(c) for c in w[1:]), total["n"])


def fit_weights(rows: DataFrame, version: str) -> Weights:
    """Component weights from the calibration, negative ones dropped, scaled to sum to one.

    Fails where no component helps: such a fit is no artifact to pin.
    """
    shares = calibrate(rows).shares()
    if shares is None:
        raise ValueError("no component has a positive coefficient; there is nothing to weigh")
    return Weights(*shares, model_version=version)


def calibration_table(spark: SparkSession, fit: Calibration, version: str) -> DataFrame:
    """One row: the weights (NULL where no component helps), the coefficients, the components left out, the rows seen."""
    names = ["velocity", "spin", "command", "pitch_count"]
    shares = fit.shares() or [None] * len(names)
    values = [version, *shares, fit.intercept, *fit.coefficients, ",".join(fit.negative), fit.rows]
    doubles = [*names, "intercept", *[f"{n}_coefficient" for n in names]]
    schema = ", ".join(["model_version string", *[f"{n} double" for n in doubles], "negative string", "n bigint"])
    table = spark.createDataFrame([tuple(values)], schema)
    return table.withColumns({n: F.round(n, 6) for n in doubles})
