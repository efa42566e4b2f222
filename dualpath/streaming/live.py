"""Three live signals as streams of their own, and the alerts that combine them.

Fatigue comes from steps.live_features. Leverage is published whenever a game's state changes, from a table that the caller
supplies. Matchup reads versions of the pitch mix and of the batters' splits, as of each pitch. The orchestrator brings the
three together by event time, each within a tolerance and each with a watermark, so a signal that is late is waited for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dualpath.functions import scores
from dualpath.functions.numbers import rounded
from dualpath.functions.scores import Composite
from dualpath.plans.lookups import LEVERAGE_STATE, leverage_state, recommendation
from dualpath.plans.signals import STATE_KEY, WARM_UP
from dualpath.schemas import PITCH_KEY
from dualpath.streaming.jobs import WATERMARK_DELAY
from dualpath.streaming.keyed import Running, carry, latest

# What a signal counts as where none is known: an average state, and a matchup that favours nobody.
NO_LEVERAGE, NO_MATCHUP = 1.0, 0.0
TOLERANCE = "10 minutes"
HEARTBEAT = -1  # the game of rows that only tell the time of a topic
RECENT = 10
SURE_AT = 50.0  # pitches of a situation at which the confidence in its mix is one half

_CONTEXT = ["inning", "inning_topbot", "outs_when_up", "bases", "home_score", "away_score", "balls", "strikes"]


def leverage_updates(pitches: DataFrame, table: DataFrame) -> DataFrame:
    """Leverage after each change of a game's state: count, bases, outs, score or half.

    `table` has a row per LEVERAGE_STATE. recent_late is how many of the game's last RECENT rows came late, and confidence the
    share of those that did not. States that the table lacks have NULL.
    """
    rows = pitches.where(~F.col("is_duplicate")).withColumns(leverage_state())
    own = list(dict.fromkeys([*PITCH_KEY, "pitcher_id", *_CONTEXT, *LEVERAGE_STATE]))
    rows = rows.select(
        *own,
        F.unix_micros("event_time").alias("clock"),
        F.col("is_late_arrival").cast("bigint").alias("late"),
        F.col("source_offset").alias("place"),
        F.to_json(F.struct(*_CONTEXT), {"ignoreNullFields": "false"}).alias("context"),
    )
    order = [
        F.col("inning"), F.when(F.col("inning_topbot") == "Top", 0).otherwise(1), F.col("at_bat_number"), F.col("pitch_number"),
        F.col("late"), F.col("place"),
    ]
    seen = carry(rows, ["game_pk"], order, Running(windows={"recent_late": ("late", RECENT)}, previous={"context_before": "context"}))
    changed = seen.where(~F.col("context").eqNullSafe(F.col("context_before")))
    return changed.join(table, LEVERAGE_STATE, "left").select(
        *PITCH_KEY,
        "pitcher_id",
        F.timestamp_micros("clock").alias("event_time"),
        (F.col("home_score") - F.col("away_score")).alias("score_differential"),
        "recent_late",
        (1 - F.col("recent_late") / F.col("recent_late_n")).alias("confidence"),
        *[c for c in table.columns if c not in LEVERAGE_STATE],
    )


def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


_VERSION = {"version": T.LongType(), "valid_from": T.TimestampType()}
MIX = _struct(
    **_VERSION, pitcher_id=T.LongType(), balls=T.IntegerType(), strikes=T.IntegerType(), batter_hand=T.StringType(),
    thrown=T.MapType(T.StringType(), T.LongType()), total=T.LongType(),
)
SPLITS = _struct(
    **_VERSION, batter_id=T.LongType(), batter_hand=T.StringType(), xwoba=T.MapType(T.StringType(), T.DoubleType())
)


class Sides:
    """Versions of the pitch mix and the splits, each valid from the time of the last pitch it has seen.

    Each version is written under its own number, so a refresh that is run again replaces its own rows only.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        for name, schema in (("mix", MIX), ("splits", SPLITS)):
            empty = spark.createDataFrame([], schema).drop("version")
            empty.write.mode("overwrite").parquet(f"{root}/{name}/version=0")

    def refresh(self, pitches: DataFrame, value: Column, version: int) -> None:
        """Adds a version from all pitches so far; `value` is a pitch's outcome value."""
        typed = pitches.where(F.col("pitch_type").isNotNull())
        # One value: the clock of this version.
        upto = pitches.agg(F.max("event_time").alias("valid_from"))
        situation = ["pitcher_id", "balls", "strikes", "batter_hand"]
        thrown = typed.groupBy(*situation, "pitch_type").agg(F.count(F.lit(1)).alias("n"))
        mix = thrown.groupBy(*situation).agg(
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("pitch_type", "n")))).alias("thrown"), F.sum("n").alias("total")
        )
        batter = ["batter_id", "batter_hand"]
        outcome = (F.sum(value.cast("decimal(18,6)")).cast("double") / F.count(value)).alias("x")
        splits = typed.groupBy(*batter, "pitch_type").agg(outcome).where(F.col("x").isNotNull())
        splits = splits.groupBy(*batter).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("pitch_type", "x")))).alias("xwoba"))
        for name, rows, schema in (("mix", mix, MIX), ("splits", splits, SPLITS)):
            columns = [f.name for f in schema if f.name != "version"]
            dated = rows.withColumn("valid_from", F.lit(upto.first()["valid_from"])).select(*columns)
            dated.write.mode("overwrite").parquet(f"{self.root}/{name}/version={version}")

    def read(self, name: str) -> DataFrame:
        """All versions, each with valid_to: where the next begins, NULL for the newest. A key that a version lacks is unknown then."""
        schema = {"mix": MIX, "splits": SPLITS}[name]
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        # One row a version.
        versions = rows.groupBy("version").agg(F.max("valid_from").alias("valid_from"))
        after = F.lead("valid_from").over(Window.orderBy("version"))
        return rows.join(versions.select("version", after.alias("valid_to")), "version")


def _as_of(pitches: DataFrame, side: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Each pitch with the side's row of its key that was valid at its time, if any."""
    named = side.select(*[F.col(k).alias(f"_{k}") for k in keys], "valid_from", "valid_to", *columns)
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    valid = (F.col("event_time") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("event_time") < F.col("valid_to")))
    return pitches.join(named, [*same, valid], "left").drop(*[f"_{k}" for k in keys], "valid_from", "valid_to")


def matchup_updates(pitches: DataFrame, sides: Sides, parks: DataFrame, league: float = 0.25) -> DataFrame:
    """Each pitch's expected outcome over the league's, by the mix and the splits that were valid at its time.

    No state: the sides are tables that are read again with every start of the stream. Types without a split are left out of
    the sum; NULL where nothing is known. `parks` has park_id and park_factor.
    """
    rows = _as_of(pitches, sides.read("mix"), ["pitcher_id", "balls", "strikes", "batter_hand"], ["version", "thrown", "total"])
    rows = _as_of(rows, sides.read("splits"), ["batter_id", "batter_hand"], ["xwoba"])
    rows = rows.join(parks, "park_id")
    shared = F.array_intersect(F.map_keys("thrown"), F.map_keys("xwoba"))
    terms = F.transform(
        F.sort_array(shared),
        lambda t: F.struct((F.col("thrown")[t] / F.col("total") * F.col("xwoba")[t]).alias("term"), t.alias("type")),
    )
    rows = rows.withColumn("terms", F.when(F.size(shared) > 0, terms))
    expected = rounded(F.aggregate("terms", F.lit(0.0), lambda s, t: s + t["term"]), 6)
    top = F.array_max(F.transform("terms", lambda t: F.struct(F.round(t["term"], 9).alias("term"), t["type"].alias("type"))))
    edge = rounded(expected * F.col("park_factor") - F.lit(league), 6)
    return rows.withColumn("matchup_edge", edge).select(
        *PITCH_KEY,
        "pitcher_id",
        "batter_id",
        "event_time",
        "version",
        "matchup_edge",
        F.when(F.col("matchup_edge").isNotNull(), recommendation(F.col("matchup_edge"))).alias("recommendation"),
        top["type"].alias("top_contributing_pitch_type"),
        (F.col("total") / (F.col("total") + F.lit(SURE_AT))).alias("confidence"),
    )


def _latest_within(rows: DataFrame, signal: DataFrame, keys: list[str], value: str, tolerance: str) -> DataFrame:
    """Each row with the signal's latest value of its key, no older than the tolerance; an interval join and its reduction.

    Time is cut into slots as long as the tolerance. A signal stands in its own slot and the next, so a row meets in its slot
    all that are near it, and not the rest of its key.
    """
    side = signal.select(*[F.col(k).alias(f"{value}_{k}") for k in keys], F.col("event_time").alias(f"{value}_time"), value)
    width = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"interval {tolerance}"))
    slot = lambda time: F.unix_micros(time) - F.pmod(F.unix_micros(time), width)
    at = F.col(f"{value}_time")
    side = side.withColumn(f"{value}_slot", F.explode(F.array(slot(at), slot(at) + width)))
    side = side.withWatermark(f"{value}_time", WATERMARK_DELAY)
    near = (at <= F.col("event_time")) & (at >= F.col("event_time") - F.expr(f"interval {tolerance}"))
    same = [F.col(k) == F.col(f"{value}_{k}") for k in [*keys, "slot"]]
    both = rows.withColumn("slot", slot(F.col("event_time"))).join(side, [*same, near], "leftOuter")
    newest = F.max(F.when(at.isNotNull(), F.struct(at.alias("at"), F.col(value).alias("value"))))
    return both.groupBy(*rows.columns).agg(newest.alias("found")).select(*rows.columns, F.col("found.value").alias(value))


def _latest_of_streams(rows: DataFrame, signals: dict[str, tuple[DataFrame, list[str]]], keys: list[str], tolerance: str) -> DataFrame:
    """The same of several signals at once, all of them streams: what is near meets in one state and is not joined row by row.

    `signals` has, by value, the signal and its keys besides `keys`.
    """
    spark = rows.sparkSession
    within = spark.sql(f"select unix_micros(timestamp_micros(0) + interval {tolerance})").first()[0]
    times = [f.name for f in rows.schema if isinstance(f.dataType, T.TimestampType)]
    in_micros = lambda df: df.withColumns({c: F.unix_micros(c) for c in times if c in df.columns})
    sides = {}
    for value, (signal, own) in signals.items():
        side = signal.select(*keys, *own, "event_time", value).withWatermark("event_time", WATERMARK_DELAY)
        sides[value] = in_micros(side), own
    return latest(in_micros(rows), sides, keys, "event_time", within).withColumns({c: F.timestamp_micros(c) for c in times})


def scored(fatigue: DataFrame, leverage: DataFrame, matchup: DataFrame, mix: Composite = Composite(), tolerance: str = TOLERANCE) -> DataFrame:
    """Fatigue of each on-time pitch from the warm-up on, with the leverage and matchup known then, and their composite.

    A row comes out when the watermark of all three has passed it, so a signal that is behind holds the others back and is not
    missed. Of several values of one time the largest counts. Rows of game HEARTBEAT move the watermark; they come out as rows
    do, for readers to leave out: a filter here would be pushed below the watermark.
    """
    rows = fatigue.where((F.col("game_pk") == HEARTBEAT) | (~F.col("is_late_arrival") & (F.col("pitch_idx") >= WARM_UP)))
    rows = rows.select(*STATE_KEY, "event_time", "ingest_time", "pitch_idx", "fatigue").withWatermark("event_time", WATERMARK_DELAY)
    signals = {"leverage": (leverage.withColumnRenamed("leverage_index", "leverage"), []), "matchup_edge": (matchup, ["pitcher_id"])}
    if all(topic.isStreaming for topic in (fatigue, leverage, matchup)):
        rows = _latest_of_streams(rows, signals, ["game_pk"], tolerance)
    else:
        for value, (signal, own) in signals.items():
            rows = _latest_within(rows, signal, ["game_pk", *own], value, tolerance)
    known = rows.withColumns(
        {
            "leverage": rounded(F.coalesce("leverage", F.lit(NO_LEVERAGE)), 2),
            "matchup_edge": rounded(F.coalesce("matchup_edge", F.lit(NO_MATCHUP)), 3),
        }
    )
    return known.withColumn("score", scores.composite_score(F.col("fatigue"), F.col("leverage"), F.col("matchup_edge"), mix))


def heartbeat(like: T.StructType, at: DataFrame) -> DataFrame:
    """One row that tells a topic's time; `at` is one row with event_time."""
    fixed = {"event_time": F.col("event_time"), "ingest_time": F.col("event_time"), "game_pk": F.lit(HEARTBEAT), "pitcher_id": F.lit(HEARTBEAT)}
    return at.select(*[fixed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in like])


def without_heartbeats(topic: DataFrame) -> DataFrame:
    return topic.where(F.col("game_pk") != HEARTBEAT)
