"""Rolling per-pitcher features and per-game workload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dualpath.functions.numbers import frame_mean, group_mean, share
from dualpath.operators.ordered import HotGroups, OrderedGroups, find_hot_groups
from dualpath.plans.staging import drop_flagged
from dualpath.schemas import PITCHER_GAME_KEY

ROLLING_WIDTH = 20
BASELINE_PITCHES = 20

# Workload buckets by pitch count.
MEDIUM_FROM = 25
HIGH_FROM = 50


def hot_pitchers(bronze: DataFrame) -> HotGroups | None:
    return find_hot_groups(bronze, PITCHER_GAME_KEY)


def pitcher_groups(hot: HotGroups | None, *tie_breaks: Column) -> OrderedGroups:
    order = (F.asc_nulls_last("at_bat_number"), F.asc_nulls_last("pitch_number"), *tie_breaks)
    return OrderedGroups(tuple(PITCHER_GAME_KEY), order, hot)


def pitcher_game_window(staged: DataFrame, hot: HotGroups | None = None) -> DataFrame:
    """Pitch ordinal, last-20 means and the first-20 baseline of each pitcher in a game."""
    groups = pitcher_groups(hot)
    rows = staged.select(
        "event_time", *PITCHER_GAME_KEY, "at_bat_number", "pitch_number", "release_speed", "release_spin_rate"
    )
    rows = groups.running(groups.split(rows), {"pitches_thrown_so_far": ("count", None)})
    rows = groups.frames(
        rows,
        ROLLING_WIDTH - 1,
        lambda w: {
            "velocity_last_20_avg": frame_mean(F.col("release_speed"), w.rowsBetween(1 - ROLLING_WIDTH, 0)),
            "spin_last_20_avg": frame_mean(F.col("release_spin_rate"), w.rowsBetween(1 - ROLLING_WIDTH, 0)),
        },
    )
    rows = groups.means_of(
        rows,
        {
            "velocity_first_20_avg": F.col("release_speed"),
            "spin_first_20_avg": F.col("release_spin_rate"),
        },
        F.col("pitches_thrown_so_far") <= BASELINE_PITCHES,
    )
    return rows.merged().drop("release_speed", "release_spin_rate")


def fatigue_bucket(pitch_count: Column) -> Column:
    return (
        F.when(pitch_count < MEDIUM_FROM, "low").when(pitch_count < HIGH_FROM, "medium").otherwise("high")
    )


def pitcher_game_fatigue(pitches: DataFrame) -> DataFrame:
    """Workload per (game, pitcher) over rows not flagged as duplicates.

    Give it deduplicated pitches for true counts; on raw rows late copies count as pitches.
    """
    return (
        drop_flagged(pitches)
        .groupBy(*PITCHER_GAME_KEY)
        .agg(
            F.min("event_time").alias("first_pitch_time"),
            F.max("event_time").alias("last_pitch_time"),
            F.count(F.lit(1)).alias("pitch_count"),
            F.max("inning").alias("max_inning"),
            group_mean(F.col("release_speed")).alias("avg_release_speed"),
            group_mean(F.col("release_spin_rate")).alias("avg_release_spin_rate"),
        )
        .withColumn("fatigue_bucket", fatigue_bucket(F.col("pitch_count")))
    )


def workload_ranking(fatigue: DataFrame) -> DataFrame:
    """The heaviest workloads first."""
    return fatigue.select(
        *PITCHER_GAME_KEY, "pitch_count", "avg_release_speed", "fatigue_bucket"
    ).orderBy(F.desc("pitch_count"), *PITCHER_GAME_KEY)


def with_pace(pitches: DataFrame, hot: HotGroups | None = None, width: int = 10) -> DataFrame:
    """Seconds since the pitcher's previous pitch and its least-squares trend over the last `width`."""
    groups = pitcher_groups(hot)
    rows = groups.frames(
        groups.split(pitches),
        1,
        lambda w: {
            "_pace": F.unix_micros("event_time") - F.lag(F.unix_micros("event_time")).over(w),
        },
    )
    # Known paces are numbered in their key; in a frame they count from one.
    rows = groups.running(rows, {"_k": ("sum", F.col("_pace").isNotNull().cast("bigint"))})

    def sums(w) -> dict[str, Column]:
        frame = w.rowsBetween(1 - width, 0)
        return {
            "_n": F.count("_pace").over(frame),
            "_y": F.coalesce(F.sum("_pace").over(frame), F.lit(0)),
            "_ky": F.coalesce(F.sum(F.col("_k") * F.col("_pace")).over(frame), F.lit(0)),
        }

    rows = groups.frames(rows, width - 1, sums).merged()
    n, y = F.col("_n"), F.col("_y")
    xy = F.col("_ky") - (F.col("_k") - n) * y
    # x runs 1..n: sum x = n(n+1)/2 and n * sum x^2 - (sum x)^2 = n^2 (n^2 - 1) / 12.
    top = (n * xy * 2 - n * (n + 1) * y) * 6
    bottom = n * n * (n * n - 1) * F.lit(1_000_000)
    slope = F.when(n >= 2, top.cast("double") / bottom.cast("double"))
    return rows.withColumns(
        {"pace_seconds": F.col("_pace") / F.lit(1_000_000.0), "pace_trend_last_10": slope}
    ).drop("_pace", "_k", "_n", "_y", "_ky")


# Half the plate's width with a ball's, the zone's usual floor and top, in feet, and how near counts as the edge.
PLATE_EDGE, ZONE_FLOOR, ZONE_TOP, EDGE_BAND = 0.83, 1.5, 3.5, 0.25
COMMAND_WIDTH, SPIN_WIDTH = 15, 20


def on_the_edge(x: Column, z: Column) -> Column:
    """Within EDGE_BAND of the zone's border, on either side of it."""
    side = (F.abs(F.abs(x) - PLATE_EDGE) <= EDGE_BAND) & z.between(ZONE_FLOOR - EDGE_BAND, ZONE_TOP + EDGE_BAND)
    height = (F.abs(z - ZONE_FLOOR) <= EDGE_BAND) | (F.abs(z - ZONE_TOP) <= EDGE_BAND)
    return side | (height & (F.abs(x) <= PLATE_EDGE + EDGE_BAND))


def season_baselines(pitches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a pitcher's season was before each game: mean pitches a game, and mean spin of each pitch type.

    Games are ordered by their first pitch. The pitches are counted once, by game and type; the windows after that have a row
    per game of a pitcher. A first game, or a type's first, has no baseline.
    """
    counts = pitches.groupBy("pitcher_id", "game_pk", "pitch_type").agg(
        F.min("event_time").alias("start"), F.count(F.lit(1)).alias("n"),
        F.sum(F.col("release_spin_rate").cast("decimal(18,6)")).alias("spin"), F.count("release_spin_rate").alias("spins"),
    )
    games = counts.groupBy("pitcher_id", "game_pk").agg(F.min("start").alias("start"), F.sum("n").alias("n"))
    games = games.withColumn("season", F.year("start"))
    earlier = [Window.partitionBy("pitcher_id", "season", *more).orderBy("start", "game_pk").rowsBetween(Window.unboundedPreceding, -1) for more in ([], ["pitch_type"])]
    usual = games.select("pitcher_id", "game_pk", (F.sum("n").over(earlier[0]) / F.count("n").over(earlier[0])).alias("usual_pitches"))
    typed = counts.where("pitch_type is not null").drop("start", "n").join(games.select("pitcher_id", "game_pk", "start", "season"), ["pitcher_id", "game_pk"])
    mean = F.sum("spin").over(earlier[1]).cast("double") / F.sum("spins").over(earlier[1])
    return usual, typed.select("pitcher_id", "game_pk", "pitch_type", F.when(F.sum("spins").over(earlier[1]) > 0, mean).alias("usual_spin"))


def fatigue_parts(pitches: DataFrame, hot: HotGroups | None = None) -> DataFrame:
    """The parts of fatigue that look at a pitcher's season: pitch count against the usual one, spin against the usual one of
    each pitch's type over the last SPIN_WIDTH, and the share of the last COMMAND_WIDTH in the zone or on its edge.

    NULL where the season has nothing before the game.
    """
    usual, spins = season_baselines(pitches)
    rows = pitches.select(
        *PITCHER_GAME_KEY, "at_bat_number", "pitch_number", "pitch_type", "release_spin_rate",
        ((F.col("zone") <= 9) | on_the_edge(F.col("plate_x"), F.col("plate_z"))).alias("commanded"),
    ).join(spins, ["pitcher_id", "game_pk", "pitch_type"], "left")
    groups = pitcher_groups(hot)
    rows = groups.running(groups.split(rows.withColumn("_gap", F.col("release_spin_rate") - F.col("usual_spin"))), {"pitch_idx": ("count", None)})
    rows = groups.frames(
        rows,
        SPIN_WIDTH - 1,
        lambda w: {
            "spin_vs_type_last_20": frame_mean(F.col("_gap"), w.rowsBetween(1 - SPIN_WIDTH, 0)),
            "command_last_15": share(F.col("commanded"), w.rowsBetween(1 - COMMAND_WIDTH, 0)),
        },
    ).merged()
    return rows.join(usual, ["pitcher_id", "game_pk"], "left").select(
        *PITCHER_GAME_KEY, "at_bat_number", "pitch_number", "pitch_idx",
        (F.col("pitch_idx") / F.col("usual_pitches")).alias("relative_pitch_count"), "spin_vs_type_last_20", "command_last_15",
    )
