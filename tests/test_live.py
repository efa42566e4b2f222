"""The three live signals and what combines them; matching, shrinkage, calibration and checks on small rows."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import START, frame, pitch
from dualpath.operators import quality
from dualpath.plans import lookups, marts, reconcile
from dualpath.session import new_run_dir
from dualpath.streaming import jobs, live, sources, steps

TOPICS = {
    "fatigue": "game_pk long, pitcher_id long, at_bat_number int, pitch_number int, is_late_arrival boolean, event_time timestamp, "
    "ingest_time timestamp, pitch_idx long, fatigue double",
    "leverage": "game_pk long, event_time timestamp, leverage_index double",
    "matchup": "game_pk long, pitcher_id long, event_time timestamp, matchup_edge double",
}


def at(minute):
    return START + datetime.timedelta(minutes=minute)


def test_scores_wait_for_the_late_signal(spark):
    root = new_run_dir(spark, "scores")
    kinds = {name: spark.createDataFrame([], ddl).schema for name, ddl in TOPICS.items()}

    def put(name, rows):
        spark.createDataFrame(rows, kinds[name]).coalesce(1).write.mode("append").parquet(f"{root}/{name}")

    def run():
        topics = [sources.read_files(spark, f"{root}/{name}", kinds[name]) for name in TOPICS]
        out = live.scored(*topics)
        jobs.append_files(out, f"{root}/out", f"{root}/checkpoint", once=True).awaitTermination()
        return live.without_heartbeats(spark.read.schema(out.schema).parquet(f"{root}/out"))

    tired = lambda i, late=False: (1, 9, 1, i, late, at(i), at(i), 20 + i, 0.5)
    put("fatigue", [tired(i) for i in range(10)] + [tired(3, True), (1, 9, 1, 99, False, at(9), at(9), 19, 0.5)])
    put("leverage", [(1, at(0), 1.5), (1, at(4), 2.5)])
    put("matchup", [])
    assert run().count() == 0
    put("matchup", [(1, 9, at(2), 0.05), (1, 8, at(2), 0.5)])
    put("fatigue", [tired(i) for i in range(60, 62)])
    assert run().count() == 0
    last = spark.createDataFrame([(at(500),)], "event_time timestamp")
    for name, kind in kinds.items():
        live.heartbeat(kind, last).write.mode("append").parquet(f"{root}/{name}")
    got = {r["pitch_number"]: (r["leverage"], r["matchup_edge"]) for r in run().collect()}
    want = {i: (1.5 if i < 4 else 2.5, 0.0 if i < 2 else 0.05) for i in range(10)}
    # An hour later nothing known is recent enough.
    assert got == want | {60: (1.0, 0.0), 61: (1.0, 0.0)}
    assert run().count() == 12


def test_signals_wait_in_one_state_a_game(spark):
    """Ties, nulls, bounds and equal rows as in plain Python; what is kept is a state per game, not rows to be compared."""
    root = new_run_dir(spark, "latest")
    kinds = {name: spark.createDataFrame([], ddl).schema for name, ddl in TOPICS.items()}
    draw = np.random.default_rng(5)
    pick = lambda *of: of[draw.integers(len(of))]
    moment = lambda: at(int(draw.integers(0, 60)))
    fatigue = [(pick(1, 1, 2, None), pick(8, 9, None), 1, i, False, pick(moment(), moment(), moment(), None), None, 20 + i, 0.5) for i in range(200)]
    fatigue += fatigue[:20]
    leverage = [(pick(1, 2, None), pick(moment(), moment(), None), pick(0.5, 1.5, 2.5, None)) for _ in range(40)]
    matchup = [(pick(1, 2, None), pick(8, 9, None), pick(moment(), moment(), None), pick(0.02, 0.05, None)) for _ in range(40)]
    last = spark.createDataFrame([(at(500),)], "event_time timestamp")
    states = []
    for part in range(2):
        for name, rows in (("fatigue", fatigue), ("leverage", leverage), ("matchup", matchup)):
            if part == 0:
                spark.createDataFrame(rows, kinds[name]).repartition(3).write.parquet(f"{root}/{name}")
            else:
                live.heartbeat(kinds[name], last).write.mode("append").parquet(f"{root}/{name}")
        out = live.scored(*[sources.read_files(spark, f"{root}/{name}", kinds[name]) for name in TOPICS])
        run = jobs.append_files(out, f"{root}/out", f"{root}/checkpoint", once=True)
        run.awaitTermination()
        states.append([(o["operatorName"], o["numRowsTotal"]) for o in run.recentProgress[0]["stateOperators"]])

    def newest(rows, time):
        near = [(when, value is not None, value or 0) for when, value in rows if when and time - datetime.timedelta(minutes=10) <= when <= time]
        return max(near)[2] if near and max(near)[1] else None

    want = set()
    for game, pitcher, _, i, _, time, *_ in fatigue:
        if time:
            lev = newest([r[1:] for r in leverage if game and r[0] == game], time)
            edge = newest([r[2:] for r in matchup if game and pitcher and r[:2] == (game, pitcher)], time)
            want.add((game, pitcher, i, 1.0 if lev is None else lev, 0.0 if edge is None else edge))
    rows = spark.read.schema(out.schema).parquet(f"{root}/out").where("game_pk is null or game_pk != -1").collect()
    got = [(r["game_pk"], r["pitcher_id"], r["pitch_number"], r["leverage"], r["matchup_edge"]) for r in rows]
    assert len(got) == len(want) and set(got) == want
    still = live.scored(*[spark.createDataFrame(rows, kinds[name]) for name, rows in (("fatigue", fatigue), ("leverage", leverage), ("matchup", matchup))])
    assert want == {(r["game_pk"], r["pitcher_id"], r["pitch_number"], r["leverage"], r["matchup_edge"]) for r in still.where("event_time is not null").collect()}
    # Two games, and the slots of ten minutes of the rows without one.
    assert [(name, kept <= 2 + 6) for name, kept in states[0]] == [("transformWithStateInPandasExec", True)]


def test_alerts_rise_once_over_restarts(spark):
    root = new_run_dir(spark, "rising")
    scores = [0.1, 0.45, 0.5, 0.3, 0.6, 0.75, 0.7, 0.2, 0.41]
    rows = [(1, 9, 1, i, 20 + i, s, s, 1.0, 0.0, at(i), at(i)) for i, s in enumerate(scores)]
    ddl = "game_pk long, pitcher_id long, at_bat_number int, pitch_number int, pitch_idx long, score double, fatigue double, leverage double, matchup_edge double, event_time timestamp, ingest_time timestamp"
    df = spark.createDataFrame(rows, ddl)
    for part in ("pitch_number < 3", "pitch_number between 3 and 5", "pitch_number > 5"):
        df.where(part).coalesce(1).write.mode("append").parquet(f"{root}/in")
        out = steps.rising(sources.read_files(spark, f"{root}/in", df.schema))
        jobs.append_files(out, f"{root}/out", f"{root}/checkpoint", once=True).awaitTermination()
    got = {(r["pitch_number"], r["severity"]) for r in spark.read.schema(out.schema).parquet(f"{root}/out").collect()}
    assert got == {(1, "info"), (4, "warning"), (5, "action"), (8, "info")}


def test_matchup_reads_the_version_of_its_time(spark):
    root = new_run_dir(spark, "sides")
    sides = live.Sides(spark, root)
    parks = spark.createDataFrame([(1, 1.0)], "park_id long, park_factor double")
    thrown = lambda minute, kind, out: pitch(minute=minute, pitch_type=kind, events=out, pitcher_id=9, batter_id=7, balls=0, strikes=0)
    shaped = lambda rows: frame(spark, rows).withColumns({"batter_hand": F.lit("L"), "park_id": F.lit(1).cast("long")})
    value = F.col("events").isNotNull().cast("int")
    ask = shaped([thrown(m, None, None) for m in (0, 5, 9, 10, 25)])
    assert {r["matchup_edge"] for r in live.matchup_updates(ask, sides, parks).collect()} == {None}
    sides.refresh(shaped([thrown(0, "FF", "hit"), thrown(5, "FF", None)]), value, 1)
    sides.refresh(shaped([thrown(0, "FF", "hit"), thrown(5, "FF", None), thrown(9, "SL", None), thrown(10, "SL", "hit")]), value, 2)
    sides.refresh(shaped([thrown(20, "CU", "hit"), thrown(20, "SL", None)]), value, 3)
    sides.refresh(shaped([thrown(20, "CU", "hit"), thrown(20, "SL", None)]), value, 3)  # run again: replaced
    got = {r["event_time"]: r for r in live.matchup_updates(ask, sides, parks).collect()}
    seen = {m: got[START.replace(tzinfo=None) + datetime.timedelta(minutes=m)] for m in (0, 5, 9, 10, 25)}
    assert [seen[m]["version"] for m in (0, 5, 9, 10, 25)] == [None, 1, 1, 2, 3]
    # 1: fastballs only, one of two hit. 2: half fastballs, half sliders, each one of two. 3: curve and slider, one of one and none.
    assert [seen[m]["matchup_edge"] for m in (5, 10, 25)] == [0.25, 0.25, 0.25]
    assert [seen[m]["top_contributing_pitch_type"] for m in (5, 10, 25)] == ["FF", "SL", "CU"]
    assert seen[25]["recommendation"] == "REPLACE" and seen[10]["confidence"] == 4 / 54


def alerts(spark, rows):
    ddl = "game_pk long, pitcher_id long, at_bat_number int, pitch_number int, severity string, score double"
    return spark.createDataFrame([(1, p, ab, n, s, 0.5) for p, ab, n, s in rows], ddl).withColumn(
        "alert_uid", F.concat_ws("-", "pitcher_id", "at_bat_number", "pitch_number")
    )


def test_alerts_meet_the_nearest_of_the_batch(spark):
    said = alerts(spark, [(1, 10, 1, "info"), (2, 10, 1, "info"), (3, 10, 1, "action"), (4, 10, 1, "info"), (5, 10, 1, "info"), (7, 10, 1, "info"), (7, 12, 1, "info")])
    meant = alerts(spark, [(1, 9, 4, "info"), (1, 12, 1, "action"), (2, 12, 5, "info"), (3, 10, 1, "info"), (4, 11, 1, "action"), (5, 13, 1, "info"), (6, 3, 3, "warning"), (7, 11, 1, "info")])
    got = {(r["pitcher_id"], r["at_bat_number"]): (r["outcome"], r["at_bats_apart"]) for r in reconcile.match_alerts(said, meant).collect()}
    assert got == {
        (1, 10): ("confirmed", 1),
        (2, 10): ("confirmed_late", 2),
        (3, 10): ("softened", 0),
        (4, 10): ("escalated", 1),
        (5, 10): ("reversed", None),
        (5, 13): ("suppressed_but_warranted", None),
        (6, 3): ("suppressed_but_warranted", None),
        (7, 10): ("confirmed_late", 1),
        (7, 12): ("confirmed", 1),
    }


def test_small_samples_are_drawn_to_the_league(spark):
    rows = [(7, "L", "FF", 1)] + [(8, "L", "FF", 0)] * 99 + [(8, "R", "SL", 1)] * 10 + [(9, "L", None, 1)]
    df = spark.createDataFrame(rows, "batter_id long, batter_hand string, pitch_type string, v int")
    got = {(r["batter_id"], r["batter_hand"], r["pitch_type"]): r["rate"] for r in lookups.shrunk_rates(df, F.col("v"), 20.0).collect()}
    league = (1 + 20 * 0.01) / 120
    assert got[None, "L", "FF"] == pytest.approx(league) and got[7, "L", "FF"] == pytest.approx((1 + 20 * league) / 21)
    assert got[8, "L", "FF"] == pytest.approx(20 * league / 119) and got[8, "R", "SL"] == pytest.approx(1.0) and len(got) == 5


def test_sketches_answer_any_range(spark):
    times = [("fatigue", START + datetime.timedelta(days=i % 3, seconds=i), i % 97) for i in range(3000)]
    df = spark.createDataFrame(times, "signal string, event_time timestamp, s int")
    df = df.withColumn("ingest_time", F.col("event_time") + F.make_dt_interval(secs=F.col("s")))
    got = reconcile.latency_report(*reconcile.signal_latencies(df)).collect()
    assert len(got) == 4 and all(r["sketch_within_error"] for r in got)
    whole = next(r for r in got if r["day"] is None)
    assert (whole["n"], whole["p50"]) == (3000, np.quantile([i % 97 for i in range(3000)], 0.5))


def test_a_fit_that_nothing_helps_is_no_artifact(spark):
    draw = np.random.default_rng(3)
    x = draw.random((500, 4))
    p = 1 / (1 + np.exp(-(1 + 3 * x[:, 0] - 4 * x[:, 1])))
    rows = [(*map(float, r), float(draw.random() < q)) for r, q in zip(x, p)]
    df = spark.createDataFrame(rows, [*marts.COMPONENTS, "label"])
    fit = marts.calibrate(df, ridge=1e-6)
    assert marts.COMPONENTS[1] in fit.negative and fit.coefficients[0] == pytest.approx(3, abs=1) and sum(fit.shares()) == pytest.approx(1)
    flipped = df.withColumn("label", 1 - F.col("label")).select(*[F.lit(0.0).alias(c) if c != marts.COMPONENTS[0] else F.col(c) for c in marts.COMPONENTS], "label")
    assert marts.calibrate(flipped).shares() is None
    with pytest.raises(ValueError):
        marts.fit_weights(flipped, "v1")
    row = marts.calibration_table(spark, marts.calibrate(flipped), "v1").first()
    assert row["velocity"] is None and row["negative"] == marts.COMPONENTS[0] and row["n"] == 500
    assert marts.calibrate(df.limit(0)).rows == 0


def test_one_pass_finds_what_single_checks_find(spark):
    child = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, None), (None, 3, "x"), (9, 4, "a"), (9, 5, "a")], "k long, n int, kind string")
    parent = spark.createDataFrame([(1,), (2,), (None,)], "id long")
    T = quality.TableChecks
    tables = [
        T("child", child, ["k", "n"], {"kind": ["a", "b"]}, [["k", "n"], ["n"], ["k"]], {"child.k": "k"}),
        T("parent", parent, unique=[["id"]], serves={"child.k": "id"}),
    ]
    got = {(r["check_name"], r["subject"]): r["violations"] for r in quality.one_pass(tables).collect()}
    single = quality.report(
        quality.column_checks(child, "child", ["k", "n"], {"kind": ["a", "b"]}),
        *[quality.unique(child, keys, "child") for keys in (["k", "n"], ["n"], ["k"])],
        quality.references(child, "k", parent, "id", "child.k"),
        quality.unique(parent, ["id"], "parent"),
    )
    assert got == {(r["check_name"], r["subject"]): r["violations"] for r in single.collect()}
    assert got["references", "child.k"] == 2 and got["unique", "child(k,n)"] == 1 and got["not_null", "child.n"] == 0
