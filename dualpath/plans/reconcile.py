"""What the stream said against what the batch concluded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dualpath.functions import scores
from dualpath.functions.events import class_label, pitcher_order_slot
from dualpath.operators.ordered import HotGroups
from dualpath.plans.features import pitcher_groups
from dualpath.plans.signals import STATE_KEY, alert_uid, with_rises
from dualpath.schemas import PITCHER_GAME_KEY

# The signals compared.
SIGNALS = ["fatigue", "leverage", "matchup_edge"]

POINTS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}

# The sketch's size and the rank error that its size gives, with room.
SKETCH_K, SKETCH_ERROR = 200, 0.03

NEAR_MARGIN = 0.05
MATERIAL_DELTA = 0.002


def _renamed(df: DataFrame, columns: list[str], prefix: str) -> DataFrame:
    return df.select(*STATE_KEY, *[F.col(c).alias(f"{prefix}_{c}") for c in columns])


def _long(df: DataFrame, extra: list[str]) -> DataFrame:
    """One row per signal with both values and their delta."""
    rows = F.array(
        *[
            F.struct(
                F.lit(s).alias("signal"),
                F.col(f"streaming_{s}").alias("streaming_value"),
                F.col(f"canonical_{s}").alias("canonical_value"),
            )
            for s in SIGNALS
        ]
    )
    flat = df.withColumn("r", F.explode(rows)).select(*STATE_KEY, *extra, "r.*")
    return flat.withColumn(
        "delta", scores.milli_delta(F.col("canonical_value"), F.col("streaming_value"))
    )


def signal_deltas(streaming: DataFrame, canonical: DataFrame) -> DataFrame:
    """Both values of each signal at each state both sides know."""
    both = _renamed(streaming, SIGNALS, "streaming").join(_renamed(canonical, SIGNALS, "canonical"), STATE_KEY)
    return _long(both, [])


def alert_values(alerts: DataFrame, canonical: DataFrame) -> DataFrame:
    """Streaming and canonical value of each signal behind each alert, with display text."""
    emitted = alerts.select(
        *STATE_KEY, "alert_uid", *[F.col(c).alias(f"streaming_{c}") for c in SIGNALS]
    )
    rows = _long(emitted.join(_renamed(canonical, SIGNALS, "canonical"), STATE_KEY), ["alert_uid"])
    return rows.withColumns(
        {
            "delta_class": scores.delta_class(F.col("delta")),
            "delta_text": scores.signed_text(F.col("delta")),
            "streaming_text": scores.signed_text(F.col("streaming_value")),
        }
    )


def _near(composite: Column, margin: float) -> Column:
    floor = scores.BANDS["info"]
    return (composite < floor) & (composite >= floor - margin)


def said_by(alerts: DataFrame, streaming: DataFrame, margin: float = NEAR_MARGIN) -> DataFrame:
    """Stored alerts, and near misses: states less than `margin` under the lowest band."""
    fired = alerts.select(
        *STATE_KEY, "alert_uid", "severity", F.col("score").alias("streaming_score"), F.lit(False).alias("near")
    )
    held = streaming.where(_near(F.col("composite"), margin)).select(
        *STATE_KEY, F.col("composite").alias("streaming_score"), F.lit(True).alias("near")
    )
    return fired.unionByName(held, allowMissingColumns=True)


def said_in_one_pass(
    streaming: DataFrame, hot: HotGroups | None = None, margin: float = NEAR_MARGIN
) -> DataFrame:
    """The same straight from the snapshots, without computing them once for alerts and once more."""
    near = _near(F.col("composite"), margin)
    rows = with_rises(streaming.withColumn("score", F.col("composite")), hot)
    fired = F.col("rises")
    return rows.where(fired | near).select(
        *STATE_KEY,
        F.when(fired, alert_uid()).alias("alert_uid"),
        F.when(fired, F.col("severity")).alias("severity"),
        F.col("score").alias("streaming_score"),
        (~fired).alias("near"),
    )


def alert_reconciliation(
    said: DataFrame, canonical: DataFrame, hot: HotGroups | None = None
) -> DataFrame:
    """One row per streaming alert, and one per near miss the batch would have raised.

    Each side is computed once; how far the batch ever got is a group value on its own rows.
    """
    position = pitcher_order_slot()
    reached = pitcher_groups(hot).maxima_of(
        canonical.select(*STATE_KEY, "composite"),
        {f"last_{n}": F.when(F.col("composite") >= floor, position) for n, floor in scores.BANDS.items()},
    )
    joined = said.join(reached.withColumnRenamed("composite", "canonical_score"), STATE_KEY, "left")
    rank = scores.severity_rank(F.col("severity"))
    meant = scores.severity_rank(scores.severity(F.coalesce("canonical_score", F.lit(0.0))))
    later = (
        F.when(F.col("severity") == "action", F.col("last_action"))
        .when(F.col("severity") == "warning", F.col("last_warning"))
        .otherwise(F.col("last_info"))
    )
    outcome = (
        F.when(F.col("near"), F.when(meant > 0, "suppressed_but_warranted"))
        .when(meant == rank, "confirmed")
        .when(meant > rank, "escalated")
        .when(later > position, "confirmed_late")
        .when(meant > 0, "softened")
        .otherwise("reversed")
    )
    return (
        joined.withColumn("outcome", outcome)
        .where(F.col("outcome").isNotNull())
        .select(
            *STATE_KEY,
            "alert_uid",
            "severity",
            "streaming_score",
            "canonical_score",
            scores.milli_delta(F.col("canonical_score"), F.col("streaming_score")).alias("delta"),
            "outcome",
            class_label(F.col("outcome")).alias("outcome_label"),
        )
    )


def outcome_distribution(reconciled: DataFrame) -> DataFrame:
    """Counts per outcome, and how action-level decisions fared."""
    action = F.col("severity") == "action"
    return reconciled.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(action).alias("n_action"),
    )


def correction_rate(reconciled: DataFrame) -> DataFrame:
    """Share of emitted alerts the batch changed, and action-level alerts kept or reversed."""
    emitted = reconciled.where(F.col("alert_uid").isNotNull())
    changed = F.count_if(F.col("outcome") != "confirmed")
    action = F.col("severity") == "action"
    return emitted.agg(
        F.count(F.lit(1)).alias("alerts"),
        (changed / F.count(F.lit(1))).alias("correction_rate"),
        F.count_if(action & (F.col("outcome") != "reversed")).alias("action_preserved"),
        F.count_if(action & (F.col("outcome") == "reversed")).alias("action_reversed"),
    )


def _first_crossings(snapshots: DataFrame, prefix: str) -> DataFrame:
    position = pitcher_order_slot()
    return snapshots.groupBy(*PITCHER_GAME_KEY).agg(
        *[
            F.min(F.when(F.col("composite") >= floor, position)).alias(f"{prefix}_{name}")
            for name, floor in scores.BANDS.items()
        ]
    )


def decision_outcomes(streaming: DataFrame, canonical: DataFrame) -> DataFrame:
    """Per pitcher, game and severity: which side got there first."""
    sides = _first_crossings(streaming, "s").join(
        _first_crossings(canonical, "c"), PITCHER_GAME_KEY, "full_outer"
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("severity"),
                F.col(f"s_{n}").alias("streaming_first"),
                F.col(f"c_{n}").alias("canonical_first"),
            )
            for n in scores.BANDS
        ]
    )
    flat = sides.select(*PITCHER_GAME_KEY, F.explode(rows).alias("r")).select(*PITCHER_GAME_KEY, "r.*")
    s, c = F.col("streaming_first"), F.col("canonical_first")
    first = (
        F.when(s.isNull() & c.isNull(), "neither")
        .when(c.isNull(), "streaming_only")
        .when(s.isNull(), "canonical_only")
        .when(s < c, "streaming")
        .when(s > c, "canonical")
        .otherwise("together")
    )
    return flat.withColumn("fired_first", first)


def percentiles(df: DataFrame, by: list[str], value: str, points: dict[str, float]) -> DataFrame:
    """Exact percentiles of an integer column per group.

    Values are counted first, so a group reaches its task as one row per distinct value.
    """
    histogram = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    grid = list(points.values())
    got = histogram.groupBy(*by).agg(
        F.percentile(value, grid, F.col("_n")).alias("_p"), F.sum("_n").alias("n")
    )
    return got.select(*by, "n", *[F.get("_p", F.lit(i)).alias(name) for i, name in enumerate(points)])


def latency_percentiles(alerts: DataFrame) -> DataFrame:
    """Seconds from event to emission per severity: p50, p95, p99."""
    latency = F.unix_seconds("emitted_time") - F.unix_seconds("event_time")
    got = percentiles(alerts.withColumn("latency", latency), ["severity"], "latency", POINTS)
    return got.select("severity", "n", *[F.round(p, 3).alias(p) for p in POINTS])


def signal_latencies(signals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Latency per signal and day: value counts, and a mergeable quantile sketch of each group.

    `signals` has signal, event_time and ingest_time, one row per emission. A day's sketch has a fixed size, so any range of
    days is answered from its days' sketches without reading emissions again.
    """
    seconds = F.unix_seconds("ingest_time") - F.unix_seconds("event_time")
    rows = signals.select("signal", F.to_date("event_time").alias("day"), seconds.alias("latency")).where("latency is not null")
    counts = rows.groupBy("signal", "day", "latency").agg(F.count(F.lit(1)).alias("n"))
    return counts, rows.groupBy("signal", "day").agg(F.kll_sketch_agg_bigint("latency", SKETCH_K).alias("sketch"))


def latency_report(counts: DataFrame, sketches: DataFrame) -> DataFrame:
    """signal, day (NULL: all days), n, exact p50, p95, p99, and whether the sketch's percentiles are within its rank error.

    The rows of all days come from merged counts and merged sketches.
    """
    every = F.explode(F.array(F.col("day"), F.lit(None).cast("date")))
    both = counts.select("signal", every.alias("day"), "latency", "n").groupBy("signal", "day", "latency").agg(F.sum("n").alias("n"))
    merged = sketches.select("signal", every.alias("day"), "sketch").groupBy("signal", "day").agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))
    key = [F.col("c.signal") == F.col("s.signal"), F.col("c.day").eqNullSafe(F.col("s.day"))]
    asked = [F.kll_sketch_get_quantile_bigint("s.sketch", F.lit(p)).alias(f"about_{name}") for name, p in POINTS.items()]
    rows = both.alias("c").join(merged.alias("s"), key).select("c.signal", "c.day", "latency", "n", *asked)
    checks = []
    for name, p in POINTS.items():
        below = F.sum(F.when(F.col("latency") < F.col(f"about_{name}"), F.col("n")).otherwise(0)) / F.sum("n")
        upto = F.sum(F.when(F.col("latency") <= F.col(f"about_{name}"), F.col("n")).otherwise(0)) / F.sum("n")
        checks.append((below <= p + SKETCH_ERROR) & (upto >= p - SKETCH_ERROR))
    out = rows.groupBy("signal", "day").agg(
        F.sum("n").alias("n"),
        F.percentile("latency", list(POINTS.values()), F.col("n")).alias("p"),
        (checks[0] & checks[1] & checks[2]).alias("sketch_within_error"),
    )
    exact = [F.round(F.get("p", F.lit(i)), 3).alias(name) for i, name in enumerate(POINTS)]
    return out.select("signal", "day", "n", *exact, "sketch_within_error")


def match_alerts(streaming: DataFrame, canonical: DataFrame, within: int = 2) -> DataFrame:
    """Each streaming alert with the nearest alert the batch raises for that pitcher, no more than `within` at-bats away, and
    each batch alert that no streaming alert is near.

    Both sides are dealt by runs of at-bats, the batch side to the neighbouring runs too, so alerts meet only near ones. Of
    equally near ones the earlier counts. No near one: reversed; a lower or higher severity there: softened, escalated; the same
    at or before the alert: confirmed, after it: confirmed_late; a batch alert alone: suppressed_but_warranted.
    """
    run = F.floor(F.col("at_bat_number") / max(1, within))
    kept = {"severity": "severity", "score": "score", "position": pitcher_order_slot()}
    columns = [*STATE_KEY, *[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in kept.items()]]
    said = streaming.select(*columns, "alert_uid", run.alias("run"))
    meant = canonical.select(*columns, F.explode(F.sequence(run - 1, run + 1)).alias("run"))
    names = [*STATE_KEY, *kept]
    meant = meant.select(*[F.col(n).alias(f"c_{n}") for n in [*names, "run"]])
    apart = F.abs(F.col("at_bat_number") - F.col("c_at_bat_number"))
    near = [F.col(n) == F.col(f"c_{n}") for n in [*PITCHER_GAME_KEY, "run"]] + [apart <= within]
    both = said.join(meant, near, "full_outer").withColumn("apart", apart)

    nearest = F.min(F.when(F.col("apart").isNotNull(), F.struct("apart", "c_position", "c_severity", "c_score"))).alias("best")
    matched = both.where(F.col("alert_uid").isNotNull()).groupBy(*names, "alert_uid").agg(nearest)
    ours, theirs = (scores.severity_rank(F.col(c)) for c in ("severity", "best.c_severity"))
    outcome = (
        F.when(F.col("best").isNull(), "reversed")
        .when(theirs > ours, "escalated")
        .when(theirs < ours, "softened")
        .when(F.col("best.c_position") > F.col("position"), "confirmed_late")
        .otherwise("confirmed")
    )
    found = matched.select(
        *STATE_KEY, "alert_uid", "severity", F.col("score").alias("streaming_score"), F.col("best.c_severity").alias("canonical_severity"),
        F.col("best.c_score").alias("canonical_score"), F.col("best.apart").alias("at_bats_apart"), outcome.alias("outcome"),
    )
    # A batch alert is alone if none of its runs holds a near one.
    theirs_only = both.where(F.col("c_position").isNotNull()).groupBy(*[F.col(f"c_{n}").alias(n) for n in names]).agg(F.count("alert_uid").alias("met"))
    none = F.lit(None).cast("string")
    alone = theirs_only.where("met = 0").select(
        *STATE_KEY, none.alias("alert_uid"), none.alias("severity"), F.lit(None).cast("double").alias("streaming_score"),
        F.col("severity").alias("canonical_severity"), F.col("score").alias("canonical_score"),
        F.lit(None).cast("int").alias("at_bats_apart"), F.lit("suppressed_but_warranted").alias("outcome"),
    )
    return found.unionByName(alone)


def delta_histogram(deltas: DataFrame, low: float = -0.5, high: float = 0.5, bins: int = 20) -> DataFrame:
    """Delta counts per signal in equal bins; below is bin 0, above is the last plus one."""
    binned = deltas.where(F.col("delta").isNotNull()).withColumn(
        "bin", F.width_bucket(F.col("delta"), F.lit(low), F.lit(high), F.lit(bins))
    )
    return binned.groupBy("signal", "bin").agg(F.count(F.lit(1)).alias("n"))


def stationarity_probe(snapshots: DataFrame, split_day: str, margin: float = NEAR_MARGIN) -> DataFrame:
    """The same thresholds in two date windows: activation rate, near misses and the evidence gap."""
    floor = scores.BANDS["info"]
    window = F.when(F.to_date("event_time") < F.lit(split_day).cast("date"), "before").otherwise("after")
    score = F.col("composite")
    rows = snapshots.select(
        window.alias("period"),
        F.round((F.lit(floor) - score) * 1000).cast("bigint").alias("gap_milli"),
    )
    # Counting per distinct gap first leaves one row per thousandth of score and period.
    counted = rows.groupBy("period", "gap_milli").agg(F.count(F.lit(1)).alias("_n"))
    gap, n = F.col("gap_milli"), F.col("_n")
    limit = round(margin * 1000)
    return counted.groupBy("period").agg(
        F.sum("_n").alias("states"),
        (F.sum(F.when(gap <= 0, n).otherwise(0)) / F.sum("_n")).alias("activation_rate"),
        (F.sum(F.when((gap > 0) & (gap <= limit), n).otherwise(0)) / F.sum("_n")).alias("near_miss_rate"),
        F.round(F.percentile("gap_milli", [0.5], n)[0], 3).alias("evidence_gap_median"),
        F.round(F.percentile("gap_milli", [0.9], n)[0], 3).alias("evidence_gap_p90"),
    )


def revision_class(delta: Column, suppressed: Column, material: float = MATERIAL_DELTA) -> Column:
    """How a later value revised the signal."""
    return (
        F.when(suppressed, "suppressed_by_governance")
        .when(F.abs(delta) >= material, "material_update")
        .otherwise("baseline_confirmed")
    )


def matchup_revisions(
    streaming: DataFrame, canonical: DataFrame, confirmed_batters: DataFrame, hold_before: int = 30
) -> DataFrame:
    """Matchup revisions per state, keeping states whose batter is not confirmed.

    Signals before pitch `hold_before` are held back by governance.
    """
    said = streaming.select(*STATE_KEY, "pitch_idx", F.col("matchup_edge").alias("streaming_value"))
    meant = canonical.select(*STATE_KEY, F.col("matchup_edge").alias("canonical_value"))
    delta = scores.milli_delta(F.col("canonical_value"), F.col("streaming_value"))
    return (
        said.join(meant, STATE_KEY)
        .join(confirmed_batters, ["game_pk", "at_bat_number", "pitch_number"], "left")
        .select(
            *STATE_KEY,
            delta.alias("delta"),
            F.when(F.col("batter_id").isNull(), "BATTER_UNCERTAIN")
            .otherwise("BATTER_CONFIRMED")
            .alias("batter_state"),
            revision_class(delta, F.col("pitch_idx") < hold_before).alias("revision"),
        )
    )


def first_signals(pitches: DataFrame, alerts: DataFrame) -> DataFrame:
    """Per game: seconds from its first pitch to the stream's first alert, and until the batch had all of it.

    The batch value of a game is known once its last pitch was taken in.
    """
    games = pitches.groupBy("game_pk").agg(
        F.min("event_time").alias("_start"), F.max("ingest_time").alias("_complete")
    )
    first = alerts.groupBy("game_pk").agg(F.min("emitted_time").alias("_first"))

    def since(c: str) -> Column:
        return (F.unix_micros(c) - F.unix_micros("_start")) / F.lit(1_000_000.0)

    return games.join(first, "game_pk", "left").select(
        "game_pk", since("_first").alias("first_signal_seconds"), since("_complete").alias("canonical_seconds")
    )
