"""Signals that need a supplied table: leverage by game state, matchup by pitch mix and batter splits.

Joins carry no broadcast hint: the tables come from data, so Spark broadcasts one only if its
measured size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dualpath.functions.numbers import rounded
from dualpath.operators.ordered import HotGroups, OrderedGroups
from dualpath.operators.transitions import game_groups, with_previous_state
from dualpath.schemas import PITCH_KEY

LEVERAGE_STATE = ["inning_bin", "inning_topbot", "outs_when_up", "bases", "score_bin"]

# Innings past the ninth share a bin, and so do leads of more than three.
LAST_INNING_BIN = 9
SCORE_BIN_LIMIT = 3


def leverage_state() -> dict[str, Column]:
    """The bounded game state the leverage table is keyed by."""
    occupied = [F.when(F.col(f"on_{b}b").isNotNull(), v).otherwise(0) for b, v in ((1, 1), (2, 2), (3, 4))]
    lead = F.col("home_score") - F.col("away_score")
    return {
        "inning_bin": F.least(F.col("inning"), F.lit(LAST_INNING_BIN)),
        "bases": occupied[0] + occupied[1] + occupied[2],
        "score_bin": F.greatest(F.lit(-SCORE_BIN_LIMIT), F.least(F.lit(SCORE_BIN_LIMIT), lead)),
    }


def leverage_table(pitches: DataFrame, hot: HotGroups | None = None) -> DataFrame:
    """Leverage per state from history: how often the score moves there against how often it does overall."""
    prev = F.col("previous")
    moved = (F.col("home_score") > prev["home_score"]) | (F.col("away_score") > prev["away_score"])
    rows = (
        with_previous_state(pitches, hot)
        .withColumns(leverage_state())
        .select(*LEVERAGE_STATE, F.coalesce(moved, F.lit(False)).cast("bigint").alias("moved"))
    )
    states = rows.groupBy(*LEVERAGE_STATE).agg(
        F.sum("moved").alias("state_moves"), F.count(F.lit(1)).alias("state_pitches")
    )
    # Second step over the bounded state table, not over the pitches.
    overall = states.agg((F.sum("state_moves") / F.sum("state_pitches")).alias("r"))
    rate = F.col("state_moves") / F.col("state_pitches")
    return states.select(*LEVERAGE_STATE, (rate / overall.scalar()).alias("leverage_index"))


def win_table(pitches: DataFrame) -> DataFrame:
    """How often the home side won from each state, over history; a game that ended level counts half.

    A game's end is its last pitch, a value per game that the pitches are joined to by game.
    """
    lead = F.col("home_score") - F.col("away_score")
    final = pitches.groupBy("game_pk").agg(F.max_by(lead, F.struct("at_bat_number", "pitch_number")).alias("final"))
    won = F.when(F.col("final") > 0, 1.0).when(F.col("final") == 0, 0.5).otherwise(0.0)
    states = pitches.withColumns(leverage_state()).groupBy("game_pk", *LEVERAGE_STATE).agg(F.count(F.lit(1)).alias("n"))
    rows = states.join(final, "game_pk").withColumn("won", won)
    return rows.groupBy(*LEVERAGE_STATE).agg((F.sum(F.col("won") * F.col("n")) / F.sum("n")).alias("win_prob_home"))


def leverage_changes(pitches: DataFrame, table: DataFrame, hot: HotGroups | None = None) -> DataFrame:
    """Leverage after each change of count, bases, outs, score or half, and how many of the last ten
    rows of the game came late."""
    state = F.struct("inning", "inning_topbot", "outs_when_up", "bases", "home_score", "away_score", "balls", "strikes")
    rows = pitches.withColumns(leverage_state()).withColumn("_state", state)
    rows = game_groups(hot).frames(
        rows,
        9,
        lambda w: {
            "_was": F.lag("_state").over(w),
            "recent_late": F.sum(F.col("is_late_arrival").cast("bigint")).over(w.rowsBetween(-9, 0)),
        },
    )
    changed = rows.where(F.col("_was").isNull() | (F.col("_was") != F.col("_state")))
    return changed.join(table, LEVERAGE_STATE, "left").select(
        *PITCH_KEY,
        (F.col("home_score") - F.col("away_score")).alias("score_differential"),
        "recent_late",
        *[c for c in table.columns if c not in LEVERAGE_STATE],
    )


def leverage_facts(pitches: DataFrame, table: DataFrame) -> DataFrame:
    """Each canonical pitch with the state it was thrown in and that state's leverage."""
    return (
        pitches.withColumns(leverage_state())
        .join(table, LEVERAGE_STATE, "left")
        .select(*PITCH_KEY, *LEVERAGE_STATE, "leverage_index")
    )


def pitch_mix(pitches: DataFrame) -> DataFrame:
    """How often a pitcher throws each type at a count to a hand, with that count's total."""
    situation = ["pitcher_id", "balls", "strikes", "batter_hand"]
    thrown = (
        pitches.where(F.col("pitch_type").isNotNull())
        .groupBy(*situation, "pitch_type")
        .agg(F.count(F.lit(1)).alias("thrown"))
    )
    # A situation has one row per pitch type by now, so its window is small.
    return thrown.withColumn("total", F.sum("thrown").over(Window.partitionBy(*situation)))


def batter_splits(pitches: DataFrame, value: Column) -> DataFrame:
    """Mean outcome value of a batter against each pitch type and hand."""
    return (
        pitches.where(F.col("pitch_type").isNotNull())
        .groupBy("batter_id", "pitch_type", "batter_hand")
        .agg((F.sum(value.cast("decimal(18,6)")).cast("double") / F.count(value)).alias("xwoba"))
    )


SPLIT_KEY = ["batter_id", "season", "batter_hand", "pitch_type"]


def splits_as_of(pitches: DataFrame, value: Column, hot: HotGroups | None = None) -> DataFrame:
    """Each pitch with its batter's mean outcome value that season so far against its type and hand.

    The pitch itself does not count; NULL where nothing came before it.
    """
    order = tuple(F.asc_nulls_last(c) for c in ("event_time", *PITCH_KEY))
    rows = pitches.where(F.col("pitch_type").isNotNull()).withColumn("_value", value.cast("decimal(18,6)"))
    rows = rows.select("event_time", *PITCH_KEY, *SPLIT_KEY, "_value")
    own = F.col("_value")
    known = own.isNotNull().cast("bigint")
    rows = OrderedGroups(tuple(SPLIT_KEY), order, hot).running(rows, {"_sum": ("sum", own), "_n": ("sum", known)})
    before, seen = F.col("_sum") - F.coalesce(own, F.lit(0)), F.col("_n") - known
    return rows.select(
        *PITCH_KEY, *SPLIT_KEY, seen.alias("seen"), F.when(seen > 0, before.cast("double") / seen).alias("xwoba_as_of")
    )


def matchup_edges(
    matchups: DataFrame, mix: DataFrame, splits: DataFrame, parks: DataFrame, league: float = 0.25
) -> DataFrame:
    """Expected outcome of pitcher against batter at a count, adjusted for the park, over the league.

    `matchups` holds distinct (pitcher_id, batter_id, balls, strikes, batter_hand, park_id). The sum
    runs over the pitcher's few pitch types. Cut-offs for the recommendation are parameters of ours.
    """
    key = ["pitcher_id", "batter_id", "balls", "strikes", "batter_hand", "park_id"]
    term = F.col("thrown") / F.col("total") * F.col("xwoba")
    terms = (
        matchups.join(mix, ["pitcher_id", "balls", "strikes", "batter_hand"])
        .join(splits, ["batter_id", "pitch_type", "batter_hand"])
        .select(*key, "pitch_type", term.alias("term"))
    )
    summed = terms.groupBy(*key).agg(
        rounded(F.sum("term"), 6).alias("expected"),
        F.max_by("pitch_type", F.struct(F.round("term", 9), F.col("pitch_type"))).alias(
            "top_contributing_pitch_type"
        ),
    )
    edge = rounded(F.col("expected") * F.col("park_factor") - F.lit(league), 6)
    return (
        summed.join(parks, "park_id")
        .withColumn("matchup_edge", edge)
        .withColumn("recommendation", recommendation(F.col("matchup_edge")))
        .select(*key, "matchup_edge", "recommendation", "top_contributing_pitch_type")
    )


def recommendation(edge: Column, warm: float = 0.02, replace: float = 0.08) -> Column:
    return F.when(edge >= replace, "REPLACE").when(edge >= warm, "WARM").otherwise("KEEP")


def shrunk_rates(pitches: DataFrame, value: Column, prior: float = 20.0) -> DataFrame:
    """batter_id (NULL: any), batter_hand, pitch_type, rate: mean outcome values, small samples drawn to the level above.

    One pass counts all levels. A batter's rate against a type counts `prior` pitches of the league's rate against it, and that
    one as many of the league's rate of the hand.
    """
    typed = pitches.where(F.col("pitch_type").isNotNull()).select("batter_id", "batter_hand", "pitch_type", value.cast("double").alias("v"))
    levels = [["batter_id", "batter_hand", "pitch_type"], ["batter_hand", "pitch_type"], ["batter_hand"]]
    sums = typed.groupingSets(levels, *levels[0]).agg(F.grouping_id().alias("level"), F.sum("v").alias("s"), F.count("v").alias("n"))
    # Levels above the batter's have a row per hand and type.
    hands = sums.where("level = 5").select(F.col("batter_hand").alias("_h"), (F.col("s") / F.col("n")).alias("above"))
    drawn = ((F.col("s") + prior * F.col("above")) / (F.col("n") + prior)).alias("rate")
    types = sums.where("level = 4").join(hands, F.col("batter_hand").eqNullSafe(F.col("_h"))).select("batter_id", "batter_hand", "pitch_type", drawn)
    league = types.select(F.col("batter_hand").alias("_h"), F.col("pitch_type").alias("_t"), F.col("rate").alias("above"))
    same = [F.col("batter_hand").eqNullSafe(F.col("_h")), F.col("pitch_type") == F.col("_t")]
    return sums.where("level = 0").join(league, same).select("batter_id", "batter_hand", "pitch_type", drawn).unionByName(types)


def matchup_facts(pitches: DataFrame, rates: DataFrame, parks: DataFrame, league: float = 0.25) -> DataFrame:
    """One row per (pitcher, batter, hand) that met: the pitcher's season mix against the batter's drawn rates, over the league.

    `pitches` has park_id, `rates` comes from shrunk_rates. Types a batter has not seen take the league's rate. The pitches are
    shuffled once, for the counts; all after that has a row per pair or per pitcher.
    """
    counts = pitches.groupBy("pitcher_id", "batter_id", "batter_hand", "pitch_type", "park_id").agg(F.count(F.lit(1)).alias("n"))
    met = counts.join(parks, "park_id").groupBy("pitcher_id", "batter_id", "batter_hand").agg(
        F.sum("n").alias("meetings"), (F.sum(F.col("n") * F.col("park_factor")) / F.sum("n")).alias("park")
    )
    thrown = counts.where(F.col("pitch_type").isNotNull()).groupBy("pitcher_id", "batter_hand", "pitch_type").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(Window.partitionBy("pitcher_id", "batter_hand"))  # a row per type by now
    mix = thrown.select("pitcher_id", "batter_hand", "pitch_type", (F.col("n") / total).alias("share"))
    own = rates.where("batter_id is not null").withColumnRenamed("rate", "own_rate")
    any_batter = rates.where("batter_id is null").select("batter_hand", "pitch_type", F.col("rate").alias("league_rate"))
    terms = (
        met.join(mix, ["pitcher_id", "batter_hand"])
        .join(any_batter, ["batter_hand", "pitch_type"])
        .join(own, ["batter_id", "batter_hand", "pitch_type"], "left")
        .withColumn("term", F.col("share") * F.coalesce("own_rate", "league_rate"))
    )
    summed = terms.groupBy("pitcher_id", "batter_id", "batter_hand", "meetings", "park").agg(
        rounded(F.sum("term"), 6).alias("expected"),
        F.max_by("pitch_type", F.struct(F.round("term", 9), F.col("pitch_type"))).alias("top_contributing_pitch_type"),
        F.count("own_rate").alias("types_seen"),
    )
    edge = rounded(F.col("expected") * F.round("park", 9) - F.lit(league), 6)
    return summed.select(
        "pitcher_id", "batter_id", "batter_hand", "meetings", "types_seen", "expected", edge.alias("matchup_edge"), "top_contributing_pitch_type"
    )
