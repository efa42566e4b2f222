"""The given tables seen as pitches and corrections.

Each event is one pitch; a game is a run of 1,000 consecutive events, so games grow in number and
not in size with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dualpath.functions.events import shift_seconds

EVENTS_PER_GAME = 1000

# Event types read as pitch types; any other type is a pitch of unknown type.
PITCH_TYPES = {"view": "FF", "click": "SL", "signup": "CH", "purchase": "CU"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _e(text: str) -> Column:
    return F.expr(text)


def _pitch_columns() -> dict[str, Column]:
    g = f"(event_id % {EVENTS_PER_GAME})"
    kind = F.lit(None).cast("string")
    for source, target in PITCH_TYPES.items():
        kind = F.when(F.col("event_type") == source, target).otherwise(kind)
    return {
        "event_time": _e("cast(ts as timestamp)"),
        "ingest_time": shift_seconds(_e("cast(ts as timestamp)"), _e("event_id % 97")),
        "game_pk": _e(f"event_id div {EVENTS_PER_GAME}"),
        "at_bat_number": _e(f"cast({g} div 5 + 1 as int)"),
        "pitch_number": _e(f"cast({g} % 5 + 1 as int)"),
        "inning": _e(f"cast({g} div 100 + 1 as int)"),
        "inning_topbot": _e(f"if(({g} div 50) % 2 = 0, 'Top', 'Bot')"),
        "pitcher_id": _e(f"user_id % 4 + if(({g} div 50) % 2 = 0, 100, 200)"),
        "batter_id": _e("event_id % 97 + 700"),
        "pitch_type": kind,
        "release_speed": _e(
            "if(event_id % 50 = 7, null, 85 + (cast(round(value * 100) as bigint) % 1500) / 100.0D)"
        ),
        "release_spin_rate": _e("cast(2000 + 5 * cast(get_json_object(props, '$.k') as int) as double)"),
        "plate_x": _e("(event_id % 41 - 20) / 10.0D"),
        "plate_z": _e("(event_id % 37) / 10.0D"),
        "zone": _e("cast(event_id % 14 + 1 as int)"),
        "balls": _e("cast(event_id % 4 as int)"),
        "strikes": _e("cast(event_id % 3 as int)"),
        "outs_when_up": _e("cast((event_id div 5) % 3 as int)"),
        "on_1b": _e("if(event_id % 3 = 0, 700 + event_id % 89, null)"),
        "on_2b": _e("if(event_id % 5 = 0, 700 + event_id % 83, null)"),
        "on_3b": _e("if(event_id % 7 = 0, 700 + event_id % 79, null)"),
        "description": _e("event_type"),
        "events": _e("if(event_id % 5 = 4, event_type, null)"),
        "home_score": _e(f"cast({g} div 90 as int)"),
        "away_score": _e(f"cast({g} div 70 as int)"),
        "is_late_arrival": F.lit(False),
        "is_duplicate": F.lit(False),
        "correction_of": F.lit(None).cast("string"),
    }


def _with_source_position(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"source_offset": F.col("event_id"), "kafka_partition": (F.col("game_pk") % 3).cast("int")}
    )


def clean_pitches(events: DataFrame) -> DataFrame:
    """One row per event, nothing repeated."""
    shaped = events.select("event_id", *[c.alias(n) for n, c in _pitch_columns().items()])
    return _with_source_position(shaped).drop("event_id")


def bronze_pitches(events: DataFrame) -> DataFrame:
    """Pitches as a replayed stream reports them: some twice, some again with an earlier clock.

    Copies come from one pass over the rows rather than from a union of three scans.
    """
    copies = F.filter(
        F.array(
            F.lit("original"),
            F.when(F.col("event_id") % 200 == 0, "duplicate"),
            F.when(F.col("event_id") % 33 == 0, "late"),
        ),
        lambda c: c.isNotNull(),
    )
    shaped = events.withColumn("copy", F.explode(copies)).select(
        "event_id", "copy", *[c.alias(n) for n, c in _pitch_columns().items()]
    )
    late = F.col("copy") == "late"
    moved = shift_seconds(F.col("event_time"), -(F.col("event_id") % 571 + 30))
    marked = shaped.withColumns(
        {
            "event_time": F.when(late, moved).otherwise(F.col("event_time")),
            "is_late_arrival": late,
            "is_duplicate": F.col("copy") == "duplicate",
        }
    )
    return _with_source_position(marked).drop("event_id", "copy")


def corrections(events: DataFrame) -> DataFrame:
    """Every 100th pitch gets its type corrected, every 200th again later, and every 300th to nothing.

    Two more fields are corrected too, and some corrections name a pitch that does not exist.
    """
    p = _pitch_columns()
    uid = F.concat_ws(":", p["game_pk"], p["at_bat_number"], p["pitch_number"])
    i = F.col("event_id")

    def fix(when: Column, field: str, new: Column, old: Column, minutes: int, name: Column = uid) -> Column:
        return F.when(
            when,
            F.struct(
                F.lit(field).alias("field"),
                old.cast("string").alias("old_value"),
                new.cast("string").alias("new_value"),
                F.lit(minutes).alias("minutes"),
                name.alias("original_pitch_uid"),
            ),
        )

    none = F.lit(None).cast("string")
    fixes = F.filter(
        F.array(
            fix(i % 100 == 0, "pitch_type", F.when(i % 300 != 0, F.lit("SI")), p["pitch_type"], 5),
            fix(i % 200 == 0, "pitch_type", F.when(i % 600 != 0, F.lit("FC")), p["pitch_type"], 30),
            fix(i % 150 == 0, "zone", i % 9 + 1, p["zone"], 12),
            fix(i % 250 == 0, "release_speed", F.lit("n/a"), p["release_speed"], 7),
            fix(i % 350 == 0, "release_speed", F.lit("91.5"), p["release_speed"], 9),
            fix(i % 400 == 0, "pitch_type", F.lit("KC"), none, 45, F.concat(F.lit("0"), uid)),
        ),
        lambda c: c.isNotNull(),
    )
    minutes = F.make_dt_interval(mins=F.col("f.minutes"))
    return events.select(
        p["event_time"].alias("t"), p["game_pk"].alias("game_pk"), F.explode(fixes).alias("f")
    ).select(
        (F.col("t") + minutes).alias("event_time"),
        (F.col("t") + minutes).alias("ingest_time"),
        "game_pk",
        "f.original_pitch_uid",
        "f.field",
        "f.old_value",
        "f.new_value",
    )


def load_bronze(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events")
    return bronze_pitches(events), corrections(events)


def raw_rows(events: DataFrame) -> DataFrame:
    """Raw text rows with the damage a scrape shows: NaN, blanks, words for numbers, mixed case.

    There is no home_score column.
    """
    i = F.col("event_id")
    p = _pitch_columns()
    nowhere = F.lit(None).cast("string")
    speed = (
        F.when(i % 7 == 0, "NaN").when(i % 7 == 1, "").when(i % 7 == 2, "abc").when(i % 7 == 3, " 95.1 ")
    )
    zone = F.when(i % 5 == 0, "nan").when(i % 5 == 1, "5.9").when(i % 5 == 2, "inf").when(i % 5 == 3, "-2.7")
    kind = F.when(i % 6 == 0, "  ").when(i % 6 == 1, "NaN").when(i % 6 == 2, "\tSL\n")
    half = F.when(i % 8 == 0, "top").when(i % 8 == 1, "TOP 1").when(i % 8 == 2, nowhere)
    return events.select(
        p["event_time"].alias("event_time"),
        p["ingest_time"].alias("ingest_time"),
        p["game_pk"].cast("string").alias("game_pk"),
        F.when(i % 501 != 500, p["at_bat_number"].cast("string")).alias("at_bat_number"),
        p["pitch_number"].cast("string").alias("pitch_number"),
        p["inning"].cast("string").alias("inning"),
        half.otherwise("bottom").alias("inning_topbot"),
        p["pitcher_id"].cast("string").alias("pitcher"),
        p["batter_id"].cast("string").alias("batter"),
        kind.otherwise(p["pitch_type"]).alias("pitch_type"),
        speed.otherwise(p["release_speed"].cast("string")).alias("release_speed"),
        p["release_spin_rate"].alias("release_spin_rate"),
        p["plate_x"].alias("plate_x"),
        p["plate_z"].alias("plate_z"),
        zone.otherwise(p["zone"].cast("string")).alias("zone"),
        p["balls"].alias("balls"),
        p["strikes"].alias("strikes"),
        p["outs_when_up"].alias("outs_when_up"),
        p["on_1b"].cast("double").alias("on_1b"),
        p["on_2b"].cast("double").alias("on_2b"),
        p["on_3b"].cast("double").alias("on_3b"),
        p["description"].alias("description"),
        p["events"].alias("events"),
        p["away_score"].alias("away_score"),
    )


def play_documents(orders: DataFrame) -> DataFrame:
    """One play-by-play and box-score document per order, built from that order's columns."""
    k = F.col("o_orderkey")

    def event(kind: Column, incoming: Column, outgoing: Column) -> Column:
        return F.struct(
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("startTime"),
            F.struct(
                kind.alias("eventType"),
                incoming.alias("replacementPlayerId"),
                outgoing.alias("playerId"),
            ).alias("details"),
        )

    change = F.lit("pitching_substitution")
    first = F.array(
        event(F.when(F.col("o_orderstatus") == "F", change).otherwise("ball"), F.col("o_custkey"), k),
        event(F.when(k % 3 == 0, change).otherwise("strike"), F.col("o_custkey") + 1, F.col("o_custkey")),
    )
    second = F.array(event(F.when(k % 5 == 0, change).otherwise("foul"), k, F.col("o_custkey")))
    plays = F.array(
        F.struct(
            F.struct((k % 9 + 1).alias("inning"), F.lit("top").alias("halfInning")).alias("about"),
            first.alias("playEvents"),
        ),
        F.struct(
            F.struct((k % 9 + 1).alias("inning"), F.when(k % 2 == 0, "bottom").alias("halfInning")).alias(
                "about"
            ),
            second.alias("playEvents"),
        ),
    )
    home = F.when(k % 4 != 0, F.struct(F.array(k, F.col("o_custkey")).alias("battingOrder")))
    away = F.struct(F.when(k % 7 != 0, F.array(F.col("o_custkey"), k, k + 1)).alias("battingOrder"))
    doc = F.to_json(F.struct(plays.alias("allPlays"), home.alias("home"), away.alias("away")))
    return orders.select(k.alias("game_pk"), doc.alias("document"))
