"""State changes between neighbouring rows of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dualpath.functions.events import game_order
from dualpath.operators.ordered import HotGroups, OrderedGroups
from dualpath.schemas import GAME_STATE

STATE = ["inning", "inning_topbot", "pitcher_id", "home_score", "away_score"]


def game_groups(hot: HotGroups | None = None) -> OrderedGroups:
    return OrderedGroups(("game_pk",), tuple(game_order()), hot)


def with_previous_state(pitches: DataFrame, hot: HotGroups | None = None) -> DataFrame:
    """Add the previous pitch's state in the game as `previous`, NULL at the game's first pitch."""
    return game_groups(hot).frames(pitches, 1, lambda w: {"previous": F.lag(F.struct(*STATE)).over(w)})


def transition_rows(rows: DataFrame, ingest_time: Column) -> DataFrame:
    """Zero or more game-state events per pitch from its own and the previous state.

    game_start stands alone. An inning or half change is an inning_start and hides the pitcher
    change that comes with it; a higher score of either side can accompany both.
    """
    prev = F.col("previous")
    start = prev.isNull()
    turned = (prev["inning"] != F.col("inning")) | (prev["inning_topbot"] != F.col("inning_topbot"))
    relieved = ~turned & (prev["pitcher_id"] != F.col("pitcher_id"))
    scored = (F.col("home_score") > prev["home_score"]) | (F.col("away_score") > prev["away_score"])

    def event(when: Column, kind: str, names_pitcher: bool) -> Column:
        return F.when(when, F.struct(F.lit(kind).alias("kind"), F.lit(names_pitcher).alias("named")))

    emitted = F.array(
        event(start, "game_start", True),
        event(turned, "inning_start", False),
        event(relieved, "pitching_change", True),
        event(scored, "scoring_play", False),
    )
    fielding = F.col("e.named") & (F.col("inning_topbot") == "Top")
    batting = F.col("e.named") & (F.col("inning_topbot") != "Top")
    return (
        rows.withColumn("e", F.explode(F.filter(emitted, lambda x: x.isNotNull())))
        .withColumns(
            {
                "ingest_time": ingest_time,
                "home_pitcher_id": F.when(fielding, F.col("pitcher_id")),
                "away_pitcher_id": F.when(batting, F.col("pitcher_id")),
                "next_batter_id": F.col("batter_id"),
                "event_type": F.col("e.kind"),
            }
        )
        .select(*[f.name for f in GAME_STATE])
    )


def game_state_events(
    pitches: DataFrame, hot: HotGroups | None = None, ingest_time: Column | None = None
) -> DataFrame:
    """Game-state events implied by consecutive pitches of each game."""
    when = F.current_timestamp() if ingest_time is None else ingest_time
    return transition_rows(with_previous_state(pitches, hot), when)


def value_changes(df: DataFrame, groups: OrderedGroups, column: str) -> DataFrame:
    """Rows whose value differs from the previous row's in the group, with the previous value."""
    rows = groups.frames(df, 1, lambda w: {f"previous_{column}": F.lag(column).over(w)})
    return rows.where(F.col(column) != F.col(f"previous_{column}"))
