"""One callable per operator, each over whole given tables."""

from __future__ import annotations

import datetime
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dualpath import schemas
from dualpath.functions.scores import Weights
from dualpath.operators import dedup, event_time, nested, perturb, quality, transitions
from dualpath.operators.ordered import OrderedGroups, find_hot_groups
from dualpath.plans import features, incremental, lookups, marts, reconcile, signals, staging
from dualpath.session import new_run_dir, tune, written
from dualpath.sources import bindings, raw, topics
from dualpath.sources import lake as lake_tables
from dualpath.sources.lake import Lake
from dualpath.streaming import jobs, live, sources, steps

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bindings.table(spark, sf_dir, "events")


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bindings.bronze_pitches(_events(spark, sf_dir))


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.staged_pitches(*bindings.load_bronze(spark, sf_dir))


def _corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.staged_pitches_all_fields(*bindings.load_bronze(spark, sf_dir))


@query
def stg_pitches(spark, sf_dir):
    return _staged(spark, sf_dir)


@query
def stg_all_fields(spark, sf_dir):
    return _corrected(spark, sf_dir)


@query
def pitcher_game_window(spark, sf_dir):
    hot = features.hot_pitchers(_bronze(spark, sf_dir))
    return features.pitcher_game_window(_staged(spark, sf_dir), hot)


@query
def silver_pitch_events(spark, sf_dir):
    return staging.silver_pitch_events(_bronze(spark, sf_dir))


@query
def pitcher_game_fatigue(spark, sf_dir):
    return features.pitcher_game_fatigue(staging.deduplicated(_bronze(spark, sf_dir)))


@query
def pitcher_game_fatigue_raw(spark, sf_dir):
    return features.pitcher_game_fatigue(_bronze(spark, sf_dir))


@query
def workload_ranking(spark, sf_dir):
    return features.workload_ranking(pitcher_game_fatigue(spark, sf_dir))


@query
def dedup_natural(spark, sf_dir):
    items = bindings.table(spark, sf_dir, "lineitem")
    newest = [F.desc("l_shipdate"), *[F.desc(c) for c in ("l_partkey", "l_suppkey", "l_extendedprice")]]
    rest = [F.desc(c) for c in ("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")]
    return dedup.newest_per_key(items, ["l_orderkey", "l_linenumber"], newest + rest)


@query
def first_20_pitches(spark, sf_dir):
    pitches = staging.deduplicated(_bronze(spark, sf_dir))
    order = [F.asc("at_bat_number"), F.asc("pitch_number")]
    return dedup.first_n_per_key(pitches, schemas.PITCHER_GAME_KEY, order, 20).select(
        *schemas.PITCHER_GAME_KEY, "at_bat_number", "pitch_number", "release_speed"
    )


def _hot_games(spark, sf_dir):
    return find_hot_groups(_bronze(spark, sf_dir), ["game_pk"])


def _states(spark, sf_dir):
    return transitions.game_state_events(
        _staged(spark, sf_dir), _hot_games(spark, sf_dir), ingest_time=F.col("ingest_time")
    )


@query
def game_state_events(spark, sf_dir):
    return _states(spark, sf_dir)


@query
def game_state_counts(spark, sf_dir):
    return _states(spark, sf_dir).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query
def role_changes(spark, sf_dir):
    turns = bindings.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    hot = find_hot_groups(turns, ["conv_id"])
    groups = OrderedGroups(("conv_id",), (F.asc_nulls_last("turn"), F.asc_nulls_last("role")), hot)
    return transitions.value_changes(turns, groups, "role")


@query
def synth_event_time(spark, sf_dir):
    pitches = _staged(spark, sf_dir).withColumn("game_date", F.to_date("event_time"))
    clocked = event_time.synthesize_event_time(pitches, _hot_games(spark, sf_dir))
    return clocked.select(*schemas.PITCH_KEY, "inning", "inning_topbot", "event_time")


@query
def late_split(spark, sf_dir):
    bronze = _bronze(spark, sf_dir)
    keys = schemas.PITCHER_GAME_KEY
    hot = find_hot_groups(bronze, keys)
    arrival = ("kafka_partition", "source_offset", "is_late_arrival", "is_duplicate")
    groups = OrderedGroups(tuple(keys), tuple(F.asc_nulls_last(c) for c in arrival), hot)
    return event_time.tag_late(bronze.select(*keys, "event_time", *arrival), groups)


@query
def clean_rows(spark, sf_dir):
    typed = raw.typed_pitches(bindings.raw_rows(_events(spark, sf_dir)))
    return quality.quarantine_split(typed, schemas.PITCH, schemas.ALLOWED_VALUES)[0]


@query
def quarantined_rows(spark, sf_dir):
    typed = raw.typed_pitches(bindings.raw_rows(_events(spark, sf_dir)))
    bad = quality.quarantine_split(typed, schemas.PITCH, schemas.ALLOWED_VALUES)[1]
    return bad.select("event_time", "game_pk", "at_bat_number", "pitch_number", "pitcher_id")


@query
def canonical_top(spark, sf_dir):
    return raw.first_pitches(staging.deduplicated(_bronze(spark, sf_dir)), 250).select(
        *schemas.PITCH_KEY, "inning", "inning_topbot", "event_time"
    )


@query
def games_list(spark, sf_dir):
    return raw.games(_bronze(spark, sf_dir))


@query
def one_game(spark, sf_dir):
    return raw.one_game(_bronze(spark, sf_dir), 3).select(*schemas.PITCH_KEY, "event_time", "is_late_arrival")


@query
def time_bounds(spark, sf_dir):
    return raw.time_bounds(_bronze(spark, sf_dir))


@query
def bronze_profile(spark, sf_dir):
    return _bronze(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("pitcher_id").alias("pitchers"),
        F.countDistinct(*schemas.PITCH_KEY).alias("pitches"),
    )


@query
def route_events(spark, sf_dir):
    bronze, corrections = bindings.load_bronze(spark, sf_dir)
    routed = topics.route_all(
        {"pitch": bronze, "game_state": _states(spark, sf_dir), "correction": corrections}
    )
    return routed.select(
        "topic",
        "key",
        F.get_json_object("value", "$.event_time").cast("bigint").alias("event_millis"),
        F.size(F.json_object_keys("value")).alias("fields"),
    )


@query
def wire_roundtrip(spark, sf_dir):
    routed = topics.route(_bronze(spark, sf_dir), "pitch")
    return topics.decode(routed, "pitch").drop("topic")


@query
def iso_encoding(spark, sf_dir):
    routed = topics.route(_bronze(spark, sf_dir), "pitch", "json_iso")
    return routed.select("key", F.get_json_object("value", "$.event_time").alias("event_time"))


@query
def perturbed_pitches(spark, sf_dir):
    pitches = bindings.clean_pitches(_events(spark, sf_dir))
    return perturb.with_copies(pitches, seed=7).select(
        *schemas.PITCH_KEY, "event_time", "ingest_time", "is_late_arrival", "is_duplicate"
    )


@query
def drawn_corrections(spark, sf_dir):
    return perturb.drawn_corrections(bindings.clean_pitches(_events(spark, sf_dir)), seed=7)


@query
def kind_counts(spark, sf_dir):
    pitches = bindings.clean_pitches(_events(spark, sf_dir))
    return perturb.kind_counts(
        perturb.with_copies(pitches, seed=7),
        perturb.drawn_corrections(pitches, seed=7),
        transitions.game_state_events(pitches, _hot_games(spark, sf_dir)),
    )


@query
def nested_plays(spark, sf_dir):
    return nested.pitching_changes(bindings.play_documents(bindings.table(spark, sf_dir, "orders")))


@query
def nested_lineups(spark, sf_dir):
    docs = bindings.play_documents(bindings.table(spark, sf_dir, "orders"))
    return nested.batting_slots(nested.lineups(docs))


@query
def quality_report(spark, sf_dir):
    t = {
        n: bindings.table(spark, sf_dir, n)
        for n in "customer documents events labels lineitem nation orders part supplier".split()
    }
    bronze = _bronze(spark, sf_dir)
    return quality.report(
        quality.column_checks(
            bronze,
            "pitches",
            [*schemas.required_fields(schemas.PITCH), "pitch_type", "release_speed", "on_1b"],
            {"inning_topbot": schemas.ALLOWED_VALUES["inning_topbot"]},
        ),
        quality.column_checks(t["lineitem"], "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate"]),
        quality.column_checks(t["events"], "events", allowed={"event_type": ["view", "click"]}),
        quality.column_checks(t["orders"], "orders", allowed={"o_orderstatus": ["F", "O", "P"]}),
        quality.unique(bronze, schemas.PITCH_KEY, "pitches"),
        quality.unique(t["lineitem"], ["l_orderkey", "l_linenumber"], "lineitem"),
        quality.unique(t["orders"], ["o_orderkey"], "orders"),
        quality.unique(t["documents"], ["doc_id"], "documents"),
        quality.references(t["lineitem"], "l_orderkey", t["orders"], "o_orderkey", "lineitem.l_orderkey"),
        quality.references(t["orders"], "o_custkey", t["customer"], "c_custkey", "orders.o_custkey"),
        quality.references(t["lineitem"], "l_suppkey", t["supplier"], "s_suppkey", "lineitem.l_suppkey"),
        quality.references(t["customer"], "c_nationkey", t["nation"], "n_nationkey", "customer.c_nationkey"),
        quality.references(t["documents"], "doc_id", t["labels"], "doc_id", "documents.doc_id"),
    )


@query
def quality_one_pass(spark, sf_dir):
    """The same checks, each table read once."""
    t = {
        n: bindings.table(spark, sf_dir, n)
        for n in "customer documents events labels lineitem nation orders part supplier".split()
    }
    Checks = quality.TableChecks
    return quality.one_pass(
        [
            Checks(
                "pitches",
                _bronze(spark, sf_dir),
                [*schemas.required_fields(schemas.PITCH), "pitch_type", "release_speed", "on_1b"],
                {"inning_topbot": schemas.ALLOWED_VALUES["inning_topbot"]},
                [schemas.PITCH_KEY],
            ),
            Checks(
                "lineitem", t["lineitem"], ["l_orderkey", "l_linenumber", "l_shipdate"], unique=[["l_orderkey", "l_linenumber"]],
                refers={"lineitem.l_orderkey": "l_orderkey", "lineitem.l_suppkey": "l_suppkey"},
            ),
            Checks("events", t["events"], allowed={"event_type": ["view", "click"]}),
            Checks(
                "orders", t["orders"], allowed={"o_orderstatus": ["F", "O", "P"]}, unique=[["o_orderkey"]],
                refers={"orders.o_custkey": "o_custkey"}, serves={"lineitem.l_orderkey": "o_orderkey"},
            ),
            Checks("documents", t["documents"], unique=[["doc_id"]], refers={"documents.doc_id": "doc_id"}),
            Checks("customer", t["customer"], refers={"customer.c_nationkey": "c_nationkey"}, serves={"orders.o_custkey": "c_custkey"}),
            Checks("supplier", t["supplier"], serves={"lineitem.l_suppkey": "s_suppkey"}),
            Checks("nation", t["nation"], serves={"customer.c_nationkey": "n_nationkey"}),
            Checks("labels", t["labels"], serves={"documents.doc_id": "doc_id"}),
        ]
    )


@query
def stream_violations(spark, sf_dir):
    """What each start of the bronze stream reports of its own rows, over four loads."""
    root, found = new_run_dir(spark, "violations"), []
    checks = {
        "no_pitch_type": F.col("pitch_type").isNull(),
        "no_release_speed": F.col("release_speed").isNull(),
        "flagged": F.col("is_duplicate"),
    }
    for n, events in enumerate(_four_loads(spark, sf_dir)):
        rows = quality.observed(bindings.bronze_pitches(events), "quality", checks)
        run = jobs.append_bronze(rows, f"{root}/pitches", f"{root}/checkpoint", once=True)
        run.awaitTermination()
        reports = [p["observedMetrics"]["quality"] for p in run.recentProgress if "quality" in p["observedMetrics"]]
        found.append((n, *[sum(r[name] for r in reports) for name in ("rows", *checks)]))
    return spark.createDataFrame(found, "load int, rows bigint, no_pitch_type bigint, no_release_speed bigint, flagged bigint")


@query
def missing_fields(spark, sf_dir):
    """Fields of a pitch that the raw rows lack, by name."""
    rows = bindings.raw_rows(_events(spark, sf_dir))
    lacking = quality.missing_columns(rows, schemas.PITCH)
    n = rows.agg(F.count(F.lit(1)).alias("rows"))
    return n.select(F.explode(F.lit(lacking)).alias("field"), "rows")


@query
def raw_day(spark, sf_dir):
    """One day of raw rows from a table laid out by day."""
    path = new_run_dir(spark, "raw")
    rows = bindings.raw_rows(_events(spark, sf_dir)).withColumn("game_date", F.to_date("event_time"))
    rows.hint("rebalance", "game_date").write.partitionBy("game_date").parquet(path)
    day = raw.load_day(spark, path, datetime.date(2024, 1, 10))
    return day.select("event_time", "game_pk", "pitcher", "zone", "game_date")


@query
def source_positions(spark, sf_dir):
    """Where each event of the stream stood in its file."""
    root = new_run_dir(spark, "positions")
    stream = sources.with_file_position(sources.read_events(spark, sf_dir)).select("event_id", "source_offset", "kafka_partition")
    jobs.append_files(stream, f"{root}/out", f"{root}/checkpoint", once=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


@query
def ingestion_stamps(spark, sf_dir):
    """Bronze rows of a run, and how many were stamped while it ran."""
    root = new_run_dir(spark, "stamps")
    began = datetime.datetime.now(datetime.timezone.utc)
    jobs.append_bronze(_bronze_stream(spark, sf_dir), f"{root}/pitches", f"{root}/checkpoint", once=True).awaitTermination()
    ended = datetime.datetime.now(datetime.timezone.utc)
    rows = spark.read.parquet(f"{root}/pitches")
    # The stamp is the batch's, in whole milliseconds.
    during = F.col("ingestion_time").between(F.lit(began - datetime.timedelta(seconds=1)), F.lit(ended))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(during).alias("stamped"), F.countDistinct("ingestion_time").alias("batches"))


@query
def declared_relations(spark, sf_dir):
    """The four bronze relations, created, filled and read under their declared names."""
    lake = _lake(spark, "relations")
    bronze, fixes = bindings.load_bronze(spark, sf_dir)
    given = {
        "pitches": bronze,
        "game_state": _states(spark, sf_dir),
        "corrections": fixes,
        "alerts": _alerts(spark, sf_dir),
    }
    out = []
    for name, identifier in lake_tables.BRONZE_RELATIONS.items():
        dated = given[name].withColumn("event_day", F.to_date("event_time"))
        lake.ensure_table(identifier, dated.schema, ["event_day"])
        lake.overwrite_partitions(dated, identifier, "event_day")
        rows = lake.read_plain(identifier)
        out.append(rows.groupBy("event_day").agg(F.count(F.lit(1)).alias("n")).withColumn("relation", F.lit(name)))
    return functools.reduce(DataFrame.unionByName, out)


@query
def pace_trend(spark, sf_dir):
    hot = features.hot_pitchers(_bronze(spark, sf_dir))
    rows = _staged(spark, sf_dir).select(*signals.STATE_KEY, "event_time")
    return features.with_pace(rows, hot)


@query
def fatigue_parts(spark, sf_dir):
    return features.fatigue_parts(_corrected(spark, sf_dir), features.hot_pitchers(_bronze(spark, sf_dir)))


def _canonical(spark, sf_dir):
    hot = features.hot_pitchers(_bronze(spark, sf_dir))
    return signals.signal_snapshots(signals.canonical_features(_corrected(spark, sf_dir), hot))


def _provisional(spark, sf_dir):
    bronze = _bronze(spark, sf_dir)
    return signals.signal_snapshots(signals.provisional_features(bronze, features.hot_pitchers(bronze)))


def _alerts(spark, sf_dir):
    hot = features.hot_pitchers(_bronze(spark, sf_dir))
    snapshots = _provisional(spark, sf_dir)
    fatigue = snapshots.select("event_time", "ingest_time", *signals.STATE_KEY, "fatigue")
    aligned = signals.align_signals(
        fatigue,
        signals.changes_only(snapshots, "leverage", hot),
        signals.changes_only(snapshots, "matchup_edge", hot),
        hot,
    )
    return signals.orchestrate(aligned, hot)


@query
def signals_canonical(spark, sf_dir):
    return _canonical(spark, sf_dir)


@query
def signals_provisional(spark, sf_dir):
    return _provisional(spark, sf_dir)


@query
def signal_display(spark, sf_dir):
    hot = features.hot_pitchers(_bronze(spark, sf_dir))
    base = signals.canonical_features(_corrected(spark, sf_dir), hot)
    return signals.display_rows(signals.signal_snapshots(base), base)


@query
def velocity_line(spark, sf_dir):
    return signals.velocity_line(_staged(spark, sf_dir), features.hot_pitchers(_bronze(spark, sf_dir)))


@query
def snapshot_at(spark, sf_dir):
    return signals.snapshot_at(_canonical(spark, sf_dir), 0, 101, 92)


@query
def alerts_banded(spark, sf_dir):
    return _alerts(spark, sf_dir)


@query
def pinned_alerts(spark, sf_dir):
    path = f"{new_run_dir(spark, 'artifact')}/weights"
    signals.save_weights(spark, Weights(model_version="fatigue_v1.1"), path)
    pinned = signals.load_weights(spark, path)
    bronze = _bronze(spark, sf_dir)
    hot = features.hot_pitchers(bronze)
    snapshots = signals.signal_snapshots(signals.provisional_features(bronze, hot), pinned)
    return signals.orchestrate(snapshots, hot, weights=pinned)


@query
def latest_alert(spark, sf_dir):
    return signals.latest_alert(_alerts(spark, sf_dir)).select("alert_uid", "emitted_time", "severity")


@query
def alert_values(spark, sf_dir):
    return reconcile.alert_values(_alerts(spark, sf_dir), _canonical(spark, sf_dir))


def _reconciled(spark, sf_dir):
    hot = features.hot_pitchers(_bronze(spark, sf_dir))
    said = reconcile.said_in_one_pass(_provisional(spark, sf_dir), hot)
    return reconcile.alert_reconciliation(said, _canonical(spark, sf_dir), hot)


@query
def stored_alert_reconciliation(spark, sf_dir):
    said = reconcile.said_by(_alerts(spark, sf_dir), _provisional(spark, sf_dir))
    hot = features.hot_pitchers(_bronze(spark, sf_dir))
    return reconcile.alert_reconciliation(said, _canonical(spark, sf_dir), hot)


@query
def alert_reconciliation(spark, sf_dir):
    return _reconciled(spark, sf_dir)


@query
def outcome_distribution(spark, sf_dir):
    return reconcile.outcome_distribution(_reconciled(spark, sf_dir))


@query
def correction_rate(spark, sf_dir):
    return reconcile.correction_rate(_reconciled(spark, sf_dir))


@query
def signal_delta(spark, sf_dir):
    return reconcile.signal_deltas(_provisional(spark, sf_dir), _canonical(spark, sf_dir))


@query
def delta_histogram(spark, sf_dir):
    return reconcile.delta_histogram(signal_delta(spark, sf_dir))


@query
def decision_outcomes(spark, sf_dir):
    return reconcile.decision_outcomes(_provisional(spark, sf_dir), _canonical(spark, sf_dir))


@query
def kpi_latency(spark, sf_dir):
    return reconcile.latency_percentiles(_alerts(spark, sf_dir))


@query
def kpi_signal_latency(spark, sf_dir):
    """Every emission of a signal: fatigue at each state, the others where they change."""
    snapshots = _provisional(spark, sf_dir)
    hot = features.hot_pitchers(_bronze(spark, sf_dir))
    times = snapshots.select(*signals.STATE_KEY, "event_time", "ingest_time")
    emitted = times.select(F.lit("fatigue").alias("signal"), "event_time", "ingest_time")
    for name in ("leverage", "matchup_edge"):
        changed = signals.changes_only(snapshots.select(*signals.STATE_KEY, "event_time", "ingest_time", name), name, hot, ["event_time", "ingest_time"])
        emitted = emitted.unionByName(changed.select(F.lit(name).alias("signal"), "event_time", "ingest_time"))
    return reconcile.latency_report(*reconcile.signal_latencies(emitted))


def _matched(spark, sf_dir):
    hot = features.hot_pitchers(_bronze(spark, sf_dir))
    sides = []
    for snapshots in (_provisional(spark, sf_dir), _canonical(spark, sf_dir)):
        rows = signals.with_rises(snapshots.withColumn("score", F.col("composite")), hot).where("rises")
        sides.append(rows.withColumn("alert_uid", signals.alert_uid()))
    return reconcile.match_alerts(*sides)


@query
def matched_alerts(spark, sf_dir):
    return _matched(spark, sf_dir)


@query
def matched_outcomes(spark, sf_dir):
    return _matched(spark, sf_dir).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query
def kpi_first_signal(spark, sf_dir):
    return reconcile.first_signals(_staged(spark, sf_dir), _alerts(spark, sf_dir))


@query
def stationarity_probe(spark, sf_dir):
    return reconcile.stationarity_probe(_canonical(spark, sf_dir), "2024-01-15")


@query
def matchup_revisions(spark, sf_dir):
    confirmed = (
        bindings.clean_pitches(_events(spark, sf_dir))
        .where(F.col("source_offset") % 10 != 0)
        .select(*schemas.PITCH_KEY, "batter_id")
    )
    return reconcile.matchup_revisions(_provisional(spark, sf_dir), _canonical(spark, sf_dir), confirmed)


@query
def leverage_lookup(spark, sf_dir):
    bronze = _bronze(spark, sf_dir)
    hot = _hot_games(spark, sf_dir)
    pitches = staging.deduplicated(bronze)
    return lookups.leverage_changes(pitches, lookups.leverage_table(pitches, hot), hot)


@query
def leverage_facts(spark, sf_dir):
    pitches = staging.deduplicated(_bronze(spark, sf_dir))
    return lookups.leverage_facts(pitches, lookups.leverage_table(pitches, _hot_games(spark, sf_dir)))


def _with_hand(pitches):
    return pitches.withColumn("batter_hand", F.when(F.col("batter_id") % 2 == 0, "L").otherwise("R"))


def _handed(spark, sf_dir):
    return _with_hand(_staged(spark, sf_dir))


def _parks(spark, sf_dir):
    return bindings.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("park_id"),
        (F.lit(0.9) + (F.col("n_nationkey") % 20) / F.lit(100.0)).alias("park_factor"),
    )


@query
def matchup_edge(spark, sf_dir):
    pitches = _handed(spark, sf_dir)
    matchups = pitches.select(
        "pitcher_id", "batter_id", "balls", "strikes", "batter_hand", (F.col("game_pk") % 25).alias("park_id")
    ).distinct()
    value = F.col("events").isNotNull().cast("int")
    return lookups.matchup_edges(
        matchups, lookups.pitch_mix(pitches), lookups.batter_splits(pitches, value), _parks(spark, sf_dir)
    )


@query
def matchup_facts(spark, sf_dir):
    pitches = _handed(spark, sf_dir).withColumn("park_id", F.col("game_pk") % 25)
    rates = lookups.shrunk_rates(pitches, F.col("events").isNotNull().cast("int"))
    return lookups.matchup_facts(pitches, rates, _parks(spark, sf_dir))


@query
def splits_as_of(spark, sf_dir):
    pitches = _handed(spark, sf_dir).withColumn("season", F.year("event_time"))
    hot = find_hot_groups(pitches, lookups.SPLIT_KEY)
    return lookups.splits_as_of(pitches, F.col("events").isNotNull().cast("int"), hot)


@query
def pitcher_season(spark, sf_dir):
    return marts.pitcher_season(_staged(spark, sf_dir))


@query
def batter_season(spark, sf_dir):
    return marts.batter_season(_handed(spark, sf_dir))


@query
def canonical_pitches(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    return marts.canonical_pitches(staged, marts.pitcher_season(staged)).select(
        *schemas.PITCH_KEY, "pitcher_id", "season", "pitch_type", "season_velocity", "season_spin", "velocity_vs_season"
    )


@query
def batter_context(spark, sf_dir):
    pitches = _handed(spark, sf_dir)
    return marts.with_batter_context(pitches, marts.batter_season(pitches)).select(
        *schemas.PITCH_KEY, "batter_id", "batter_hand", "pitch_type", "batter_pitches_seen", "batter_mean_speed_faced"
    )


def _labels(spark, sf_dir):
    bronze = _bronze(spark, sf_dir)
    hot = find_hot_groups(bronze, ["game_pk", "inning_topbot"])
    return marts.removal_label(_staged(spark, sf_dir), hot)


@query
def removal_label(spark, sf_dir):
    return _labels(spark, sf_dir)


@query
def calibrated_weights(spark, sf_dir):
    rows = marts.training_rows(_canonical(spark, sf_dir), _labels(spark, sf_dir))
    return marts.calibration_table(spark, marts.calibrate(written(rows, "training")), "fatigue_v1.1")


@query
def tumble_counts_batch(spark, sf_dir):
    return jobs.windowed_counts(_bronze(spark, sf_dir))


def _bronze_stream(spark, sf_dir):
    return bindings.bronze_pitches(sources.read_events(spark, sf_dir))


@query
def tumble_counts_stream(spark, sf_dir):
    root = new_run_dir(spark, "tumble")
    counts = jobs.windowed_counts(_bronze_stream(spark, sf_dir))
    jobs.append_files(counts, f"{root}/counts", f"{root}/checkpoint", once=True).awaitTermination()
    return spark.read.schema(counts.schema).parquet(f"{root}/counts")


@query
def bronze_stream_append(spark, sf_dir):
    root = new_run_dir(spark, "bronze")
    stream = _bronze_stream(spark, sf_dir)
    jobs.append_bronze(stream, f"{root}/pitches", f"{root}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{root}/pitches").drop("ingestion_time")


@query
def multi_sink(spark, sf_dir):
    root = new_run_dir(spark, "smoke")
    jobs.wait_all(jobs.start_smoke_job(_bronze_stream(spark, sf_dir), root, once=True))
    arrivals = jobs.read_batches(spark, f"{root}/arrivals").groupBy("pitcher_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("event_time").alias("latest")
    )
    bronze = jobs.read_batches(spark, f"{root}/bronze").groupBy("pitcher_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("event_time").alias("latest")
    )
    counted = spark.read.parquet(f"{root}/counts").groupBy("pitcher_id").agg(
        F.sum("pitch_count").alias("n"), F.max("window_end").alias("latest")
    )
    return (
        arrivals.withColumn("sink", F.lit("arrivals"))
        .unionByName(bronze.withColumn("sink", F.lit("bronze")))
        .unionByName(counted.withColumn("sink", F.lit("counts")))
    )


def _stream(fn: Query) -> Query:
    """Gives the streams of a query as many state partitions as the events and the cluster call for, and no more than shuffles have.

    Each partition of each operator is a store that every batch opens and commits, however few rows it holds.
    """

    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        name = "spark.sql.shuffle.partitions"
        before = spark.conf.get(name)
        spark.conf.set(name, jobs.state_partitions(spark, f"{sf_dir}/events.parquet"))
        try:
            return fn(spark, sf_dir)
        finally:
            spark.conf.set(name, before)

    return run


def _one_load(spark, sf_dir):
    """The stream of all events at once."""
    yield sources.read_events(spark, sf_dir)


def _load_folders(spark, sf_dir):
    folder = new_run_dir(spark, "loads")
    for _ in sources.append_events(spark, sf_dir, folder):
        yield folder


def _four_loads(spark, sf_dir):
    """The events in four loads; each time the stream is taken up anew."""
    for folder in _load_folders(spark, sf_dir):
        yield sources.read_files(spark, folder, sources.EVENTS)


def _appended(spark, sf_dir, loads, job, partitions=()):
    """What a job has appended once every load has run and ended, each from the checkpoint of the one before."""
    root = new_run_dir(spark, "job")
    for events in loads(spark, sf_dir):
        out = job(events)
        jobs.append_files(out, f"{root}/out", f"{root}/checkpoint", partitions, once=True).awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/out")


def _features_of(events):
    return steps.live_features(bindings.bronze_pitches(events))


def _live_features(spark, sf_dir, loads):
    rows = _appended(spark, sf_dir, loads, _features_of)
    return rows.select(*signals.STATE_KEY, "is_late_arrival", "event_time", "pitch_idx", *steps.LIVE_FEATURES)


def _live_alerts(spark, sf_dir, loads):
    """Two jobs: one appends features, the other reads them as its own stream."""
    root = new_run_dir(spark, "alerts")
    for events in loads(spark, sf_dir):
        features = _features_of(events)
        jobs.append_files(features, f"{root}/features", f"{root}/checkpoint/features", once=True).awaitTermination()
        alerts = steps.live_alerts(sources.read_files(spark, f"{root}/features", features.schema))
        jobs.append_files(alerts, f"{root}/alerts", f"{root}/checkpoint/alerts", once=True).awaitTermination()
    return spark.read.schema(alerts.schema).parquet(f"{root}/alerts")


def _live_states(spark, sf_dir, loads):
    job = lambda events: steps.game_states(bindings.clean_pitches(events), F.col("ingest_time"))
    return _appended(spark, sf_dir, loads, job)


def _live_late(spark, sf_dir, loads):
    job = lambda events: steps.tagged_late(bindings.bronze_pitches(events))
    return _appended(spark, sf_dir, loads, job, ("is_late",)).where("is_late")


def _live_changes(spark, sf_dir, loads):
    root = new_run_dir(spark, "changes")
    for events in loads(spark, sf_dir):
        job = jobs.append_batches(bindings.corrections(events), f"{root}/log", f"{root}/checkpoint", steps.newest_changes, once=True)
        job.awaitTermination()
    return steps.newest_changes(jobs.read_batches(spark, f"{root}/log"))


@query
@_stream
def stream_features(spark, sf_dir):
    return _live_features(spark, sf_dir, _one_load)


@query
@_stream
def stream_alerts(spark, sf_dir):
    return _live_alerts(spark, sf_dir, _one_load)


@query
@_stream
def stream_game_state(spark, sf_dir):
    return _live_states(spark, sf_dir, _one_load)


@query
@_stream
def stream_late_rows(spark, sf_dir):
    return _live_late(spark, sf_dir, _one_load)


@query
def stream_corrections(spark, sf_dir):
    return _live_changes(spark, sf_dir, _one_load)


@query
@_stream
def resumed_features(spark, sf_dir):
    return _live_features(spark, sf_dir, _four_loads)


@query
@_stream
def resumed_alerts(spark, sf_dir):
    return _live_alerts(spark, sf_dir, _four_loads)


@query
@_stream
def resumed_game_state(spark, sf_dir):
    return _live_states(spark, sf_dir, _four_loads)


@query
@_stream
def resumed_late_rows(spark, sf_dir):
    return _live_late(spark, sf_dir, _four_loads)


@query
def resumed_corrections(spark, sf_dir):
    return _live_changes(spark, sf_dir, _four_loads)


@query
def resumed_bronze(spark, sf_dir):
    root = new_run_dir(spark, "resumed-bronze")
    for events in _four_loads(spark, sf_dir):
        rows = bindings.bronze_pitches(events)
        jobs.append_bronze(rows, f"{root}/pitches", f"{root}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{root}/pitches").drop("ingestion_time")


def _late_loads(spark, sf_dir, folder):
    """Bronze rows in four loads by their position, late copies one load after their pitch."""
    rows = _bronze(spark, sf_dir)
    low, high = rows.agg(F.min("source_offset"), F.max("source_offset")).first()
    quarter = F.expr(f"(source_offset - {low or 0}) * 4 div {(high or 0) + 1 - (low or 0)}")
    load = F.least(F.lit(3), quarter + F.col("is_late_arrival").cast("int"))
    yield from sources.append_parts(rows, folder, load, 4)


def _counted_loads(spark, sf_dir):
    """Windowed counts over the loads, the stream started anew for each; what each start refused by its own progress."""
    root, refused = new_run_dir(spark, "windows"), []
    for n in _late_loads(spark, sf_dir, f"{root}/in"):
        rows = sources.read_files(spark, f"{root}/in", _bronze(spark, sf_dir).schema)
        counts = jobs.windowed_counts(rows)
        run = jobs.append_files(counts, f"{root}/counts", f"{root}/checkpoint", once=True)
        run.awaitTermination()
        refused.append((n, jobs.refused_by_watermark(run)))
    return spark.read.parquet(f"{root}/in"), spark.read.schema(counts.schema).parquet(f"{root}/counts"), refused


@query
def resumed_tumble(spark, sf_dir):
    return _counted_loads(spark, sf_dir)[1]


@query
def refused_windows(spark, sf_dir):
    """Per load, the (game, pitcher, window) groups that came too late, as the query's own progress counts them."""
    return spark.createDataFrame(_counted_loads(spark, sf_dir)[2], "load int, refused bigint")


@query
def refused_rows(spark, sf_dir):
    """Bronze rows of closed windows that the counts lack."""
    bronze, counts, _ = _counted_loads(spark, sf_dir)
    closed = counts.agg(F.max("window_end").alias("upto"))
    return jobs.missing_from_counts(bronze, counts, closed)


def _leverage_table(spark, sf_dir):
    """The table as it is pinned when the stream starts."""
    pitches = staging.deduplicated(_bronze(spark, sf_dir))
    table = lookups.leverage_table(pitches, _hot_games(spark, sf_dir))
    return written(table.join(lookups.win_table(pitches), lookups.LEVERAGE_STATE), "leverage")


@query
def win_table(spark, sf_dir):
    return lookups.win_table(staging.deduplicated(_bronze(spark, sf_dir)))


@query
@_stream
def live_leverage(spark, sf_dir):
    table = _leverage_table(spark, sf_dir)
    return _appended(spark, sf_dir, _four_loads, lambda events: live.leverage_updates(bindings.bronze_pitches(events), table))


def _matchup_of(spark, sf_dir, events, sides):
    pitches = _with_hand(bindings.clean_pitches(events)).withColumn("park_id", F.col("game_pk") % 25)
    return live.matchup_updates(pitches, sides, _parks(spark, sf_dir))


def _refresh(spark, folder, sides, version):
    so_far = _with_hand(bindings.clean_pitches(spark.read.schema(sources.EVENTS).parquet(folder)))
    sides.refresh(so_far, F.col("events").isNotNull().cast("int"), version)


@query
def live_matchup(spark, sf_dir):
    """The sides are refreshed after each load, so each load is read against what was known before it."""
    root = new_run_dir(spark, "matchup")
    sides = live.Sides(spark, f"{root}/sides")
    for n, folder in enumerate(_load_folders(spark, sf_dir)):
        out = _matchup_of(spark, sf_dir, sources.read_files(spark, folder, sources.EVENTS), sides)
        jobs.append_files(out, f"{root}/out", f"{root}/checkpoint", once=True).awaitTermination()
        _refresh(spark, folder, sides, n + 1)
    return spark.read.schema(out.schema).parquet(f"{root}/out")


def _live_scores(spark, sf_dir, with_alerts):
    """Three jobs write a topic each, the orchestrator joins them; matchup is always one load behind.

    A last heartbeat on every topic closes what is still waiting.
    """
    root, table = new_run_dir(spark, "orchestra"), _leverage_table(spark, sf_dir)
    sides = live.Sides(spark, f"{root}/sides")
    jobs_of = {
        "fatigue": _features_of,
        "leverage": lambda events: live.leverage_updates(bindings.bronze_pitches(events), table),
        "matchup": lambda events: _matchup_of(spark, sf_dir, events, sides),
    }
    empty = spark.createDataFrame([], sources.EVENTS)
    kinds = {name: job(empty).schema for name, job in jobs_of.items() if name == "matchup"}

    def publish(folder, *names):
        runs = []
        for name in names:
            out = jobs_of[name](sources.read_files(spark, folder, sources.EVENTS))
            kinds[name] = out.schema
            runs.append(jobs.append_files(out, f"{root}/{name}", f"{root}/checkpoint/{name}", once=True))
        jobs.wait_all(runs)

    def topic(name):
        beats = sources.read_files(spark, f"{root}/beats/{name}", kinds[name])
        return sources.read_files(spark, f"{root}/{name}", kinds[name]).unionByName(beats)

    def orchestrate():
        scored = live.scored(topic("fatigue"), topic("leverage"), topic("matchup"))
        jobs.append_files(scored, f"{root}/scores", f"{root}/checkpoint/scores", once=True).awaitTermination()
        if not with_alerts:
            return live.without_heartbeats(spark.read.schema(scored.schema).parquet(f"{root}/scores"))
        alerts = steps.rising(live.without_heartbeats(sources.read_files(spark, f"{root}/scores", scored.schema)))
        jobs.append_files(alerts, f"{root}/alerts", f"{root}/checkpoint/alerts", once=True).awaitTermination()
        return spark.read.schema(alerts.schema).parquet(f"{root}/alerts")

    spark.createDataFrame([], kinds["matchup"]).write.parquet(f"{root}/matchup")
    for n, folder in enumerate(_load_folders(spark, sf_dir)):
        publish(folder, "fatigue", "leverage")
        if n == 0:
            for name, kind in kinds.items():
                spark.createDataFrame([], kind).write.parquet(f"{root}/beats/{name}")
        orchestrate()
        publish(folder, "matchup")
        _refresh(spark, folder, sides, n + 1)
    last = spark.read.parquet(f"{root}/fatigue").agg((F.max("event_time") + F.expr("interval 1 day")).alias("event_time"))
    for name, kind in kinds.items():
        live.heartbeat(kind, last).write.mode("append").parquet(f"{root}/beats/{name}")
    return orchestrate()


@query
@_stream
def live_scores(spark, sf_dir):
    return _live_scores(spark, sf_dir, False)


@query
@_stream
def live_alerts(spark, sf_dir):
    return _live_scores(spark, sf_dir, True)


def _lake(spark, name):
    root = new_run_dir(spark, name)
    lake = Lake(spark, root, suffix="_" + root.rsplit("-", 1)[1])
    lake.create_namespaces()
    return lake


def _two_loads(spark, sf_dir, lake):
    """Commit the events in two loads; the second also brings late copies of the first."""
    bronze, fixes = bindings.load_bronze(spark, sf_dir)
    lake.ensure_snapshot_table("bronze.pitches", bronze.schema)
    lake.ensure_snapshot_table("bronze.corrections", fixes.schema)
    middle = _events(spark, sf_dir).agg(F.floor(F.max("event_id") / 2).alias("m")).first()["m"]
    second = (F.col("source_offset") > middle) | F.col("is_late_arrival")
    lake.commit(bronze.where(~second), "bronze.pitches", 0)
    lake.commit(fixes.where(F.col("old_value").isNotNull()), "bronze.corrections", 0)
    yield
    lake.commit(bronze.where(second), "bronze.pitches", 1)
    lake.commit(fixes.where(F.col("old_value").isNull()), "bronze.corrections", 1)
    yield


@query
def snapshot_query(spark, sf_dir):
    lake = _lake(spark, "snapshots")
    list(_two_loads(spark, sf_dir, lake))
    text = "SELECT pitcher_id, count(*) AS n, count(DISTINCT game_pk) AS games FROM bronze_pitches GROUP BY 1"
    before = lake.query_snapshot(text, "bronze.pitches", 0, "bronze_pitches").withColumn("snapshot_id", F.lit(0))
    after = lake.query(text, {"bronze_pitches": "bronze.pitches"}).withColumn("snapshot_id", F.lit(1))
    return before.unionByName(after)


@query
def count_where(spark, sf_dir):
    lake = _lake(spark, "counts")
    list(_two_loads(spark, sf_dir, lake))
    wheres = [None, "is_duplicate", "inning_topbot = 'Top' AND event_day >= DATE'2024-01-10'"]
    rows = [(w or "all", lake.count_rows("bronze.pitches", w)) for w in wheres]
    return spark.createDataFrame(rows, "predicate string, n bigint")


@query
def incremental_equals_full(spark, sf_dir):
    lake = _lake(spark, "incremental")
    incremental.ensure_window_table(lake, "silver.pitcher_game_window")
    for done, _ in enumerate(_two_loads(spark, sf_dir, lake)):
        incremental.refresh(
            lake,
            "bronze.pitches",
            "bronze.corrections",
            "silver.pitcher_game_window",
            after=done - 1 if done else None,
            games_per_part=3,
        )
    return lake.read_plain("silver.pitcher_game_window").drop("game_part")
