"""Play-by-play and box-score JSON documents, one per row, as flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The part of the documents that is read.
PLAYS = """allPlays array<struct<
  about: struct<inning: int, halfInning: string>,
  playEvents: array<struct<
    startTime: string,
    details: struct<eventType: string, replacementPlayerId: bigint, playerId: bigint>>>>>"""

BOX_SCORE = "home struct<battingOrder: array<bigint>>, away struct<battingOrder: array<bigint>>"

SUBSTITUTION = "pitching_substitution"


def pitching_changes(docs: DataFrame, document: str = "document") -> DataFrame:
    """One row per pitching substitution, with the game it belongs to."""
    plays = docs.select("game_pk", F.explode(F.from_json(document, PLAYS).getField("allPlays")).alias("p"))
    events = plays.select("game_pk", "p.about", F.explode("p.playEvents").alias("e"))
    half = F.coalesce("about.halfInning", F.lit(""))
    return events.where(F.col("e.details.eventType") == SUBSTITUTION).select(
        "game_pk",
        F.col("about.inning").alias("inning"),
        F.concat(F.upper(F.substring(half, 1, 1)), F.lower(F.substr(half, F.lit(2)))).alias("inning_topbot"),
        F.col("e.startTime").alias("about_time"),
        F.col("e.details.replacementPlayerId").alias("incoming_pitcher_id"),
        F.col("e.details.playerId").alias("outgoing_pitcher_id"),
    )


def lineups(docs: DataFrame, document: str = "document") -> DataFrame:
    """Home and away batting orders; empty where the document has none."""
    box = F.from_json(document, BOX_SCORE)
    none = F.array().cast("array<bigint>")
    return docs.select(
        "game_pk",
        *[F.coalesce(box[side]["battingOrder"], none).alias(side) for side in ("home", "away")],
    )


def batting_slots(orders: DataFrame) -> DataFrame:
    """One row per side and batting position."""
    sides = F.array(
        *[F.struct(F.lit(s).alias("side"), F.col(s).alias("batters")) for s in ("home", "away")]
    )
    return (
        orders.select("game_pk", F.explode(sides).alias("s"))
        .select("game_pk", "s.side", F.posexplode("s.batters").alias("pos", "batter_id"))
        .select("game_pk", "side", (F.col("pos") + 1).alias("batting_slot"), "batter_id")
    )
