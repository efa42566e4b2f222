"""Streams against the batch answer, across several micro-batches and restarts."""

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import START, frame, pitch, twelve_rows
from dualpath.operators import transitions
from dualpath.operators.corrections import latest_corrections
from dualpath.schemas import CORRECTION, PITCH
from dualpath.session import new_run_dir
from dualpath.streaming import jobs, keyed, sources, steps


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def drop_files(df, path, parts):
    """Write each part as one more file of the stream's folder, oldest first."""
    for part in parts:
        df.where(part).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def game_log(spark):
    """Two games of 150 pitches; some copies arrive flagged, some late."""
    rows = []
    for g in (1, 2):
        for i in range(150):
            base = pitch(
                g, i, at_bat_number=i // 5 + 1, pitch_number=i % 5 + 1, pitcher_id=10 + i // 70, zone=i % 14 + 1,
                pitch_type=["FF", "SL", None][i % 3], release_speed=95 - i * 0.05, home_score=i // 40,
                inning=i // 50 + 1,
            )
            rows.append(base)
            if i % 20 == 0:
                rows.append({**base, "is_duplicate": True})
            if i % 17 == 0:
                early = base["event_time"] - datetime.timedelta(seconds=290)
                rows.append({**base, "event_time": early, "is_late_arrival": True})
    rows.sort(key=lambda r: (r["at_bat_number"], r["pitch_number"], r["game_pk"]))
    return frame(spark, rows, position=True)


def thirds(column):
    return [F.col(column) < 11, (F.col(column) >= 11) & (F.col(column) < 21), F.col(column) >= 21]


def run_job(spark, df, job, parts):
    """What the job appends; it is stopped after each part and started again from its checkpoint."""
    root = new_run_dir(spark, "test")
    for part in parts:
        drop_files(df, f"{root}/in", [part])
        out = job(sources.read_files(spark, f"{root}/in", df.schema))
        jobs.append_files(out, f"{root}/out", f"{root}/checkpoint", once=True).awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/out"), root


WHOLE = ["true"]


def test_live_features_equal_one_batch(spark, game_log):
    split, _ = run_job(spark, game_log, steps.live_features, thirds("at_bat_number"))
    whole, _ = run_job(spark, game_log, steps.live_features, WHOLE)
    assert split.count() == game_log.where("not is_duplicate").count() and same(split, whole)
    alerts = [run_job(spark, rows.orderBy("pitch_idx"), steps.live_alerts, WHOLE)[0] for rows in (split, whole)]
    halves, _ = run_job(spark, whole, steps.live_alerts, thirds("at_bat_number"))
    assert halves.count() > 0 and same(*alerts) and same(halves, alerts[0])


def test_the_store_holds_what_is_small(spark, game_log):
    """One row a key, with no more past values than the widest frame, after any number of batches."""
    _, root = run_job(spark, game_log, steps.live_features, thirds("at_bat_number"))
    held = spark.read.format("statestore").option("stateVarName", "carried").load(f"{root}/checkpoint")
    rows = held.select("key.*", "value.*").collect()
    fresh = game_log.where("not is_duplicate").groupBy("game_pk", "pitcher_id").count().collect()
    assert {(r["game_pk"], r["pitcher_id"]): r["rows"] for r in rows} == {tuple(r)[:2]: r["count"] for r in fresh}
    widest = max(n for _, n in [*steps.LIVE.windows.values(), *steps.LIVE.gaps.values()])
    assert all(len(r[f"w{i}"]) < widest for r in rows for i in range(len(steps.LIVE.windows)))


def test_game_states_equal_batch(spark, game_log):
    clean = game_log.where("not is_duplicate and not is_late_arrival")
    got, _ = run_job(spark, clean, lambda s: steps.game_states(s, F.col("ingest_time")), thirds("at_bat_number"))
    assert same(got, transitions.game_state_events(clean, ingest_time=F.col("ingest_time")))


def test_keys_go_on_where_they_were(spark, game_log):
    """Game 2 runs between the two halves of game 1, and a game without a number is a game of its own."""
    log = game_log.withColumn("game_pk", F.when(F.col("game_pk") == 1, F.col("game_pk")))
    early = F.col("game_pk").isNotNull() & (F.col("at_bat_number") < 16)
    parts = [early, F.col("game_pk").isNull(), F.col("game_pk").isNotNull() & (F.col("at_bat_number") >= 16)]
    split, _ = run_job(spark, log, steps.live_features, parts)
    whole, _ = run_job(spark, log, steps.live_features, WHOLE)
    assert same(split, whole) and split.where("game_pk is null").agg(F.max("pitch_idx")).first()[0] > 50


def test_twelve_pitch_game_as_a_stream(spark):
    df = frame(spark, twelve_rows())
    got, _ = run_job(spark, df, steps.game_states, [F.col("at_bat_number") == i for i in range(1, 6)])
    assert {r["event_type"]: r["count"] for r in got.groupBy("event_type").count().collect()} == {
        "game_start": 1,
        "inning_start": 2,
        "pitching_change": 2,
        "scoring_play": 2,
    }


def test_late_rows_do_not_depend_on_batching(spark, game_log):
    moved = game_log.withColumn(
        "event_time", F.when(F.col("is_late_arrival"), F.expr("event_time - interval 5 minutes")).otherwise(F.col("event_time"))
    )
    split, _ = run_job(spark, moved, steps.tagged_late, thirds("at_bat_number"))
    whole, _ = run_job(spark, moved, steps.tagged_late, WHOLE)
    assert split.where("is_late").count() > 0 and same(split, whole)


def test_running_values(spark):
    schema = "k long, o long, x long, s string"
    one = [(1, 1, 10, "a"), (1, 2, None, "b"), (2, 1, 5, None), (None, 3, 7, "q")]
    two = [(1, 4, 40, "c"), (1, 3, 30, None), (2, 2, 6, "z"), (None, 4, 8, "r")]
    spec = keyed.Running("i", {"w": ("x", 2)}, {"g": ("x", 1)}, {"t": "x"}, {"f": ("x", 2)}, {"ps": "s", "px": "x"}, {"h": "x"})
    df = spark.createDataFrame(one + two, schema)
    first = "(k = 1 and o < 3) or (k = 2 and o = 1) or (k is null and o = 3)"
    parts = [F.expr(first), ~F.coalesce(F.expr(first), F.lit(False))]
    got, _ = run_job(spark, df, lambda s: keyed.carry(s, ["k"], [F.col("o")], spec), parts)
    assert {tuple(r) for r in got.collect()} == {
        (None, 3, 7, "q", 1, 7, 1, 0, 0, 7, 1, 7, 7, None, None),
        (None, 4, 8, "r", 2, 15, 2, 1, 1, 15, 2, 15, 8, "q", 7),
        (1, 1, 10, "a", 1, 10, 1, 0, 0, 10, 1, 10, 10, None, None),
        (1, 2, None, "b", 2, 10, 1, 0, 0, 10, 1, 10, 10, "a", 10),
        (1, 3, 30, None, 3, 30, 1, 0, 0, 10, 1, 40, 30, "b", None),
        (1, 4, 40, "c", 4, 70, 2, 10, 1, 10, 1, 80, 40, None, 30),
        (2, 1, 5, None, 1, 5, 1, 0, 0, 5, 1, 5, 5, None, None),
        (2, 2, 6, "z", 2, 11, 2, 1, 1, 11, 2, 11, 6, None, 5),
    }


def test_change_log_reads_as_latest(spark):
    at = [START + datetime.timedelta(minutes=m) for m in range(4)]
    rows = [
        (at[0], at[0], 1, "1:1:1", "pitch_type", "FF", "SI"),
        (at[2], at[2], 1, "1:1:1", "pitch_type", "SI", "FC"),
        (at[1], at[1], 1, "1:1:1", "zone", "1", "2"),
        (at[3], at[3], 1, "1:1:2", "pitch_type", "SL", None),
    ]
    df = spark.createDataFrame(rows, CORRECTION)
    parts = [F.col("event_time") <= F.lit(at[1]), F.col("event_time") > F.lit(at[1])]
    root = new_run_dir(spark, "changes")
    for part in parts:
        drop_files(df, f"{root}/in", [part])
        stream = sources.read_files(spark, f"{root}/in", df.schema)
        jobs.append_batches(stream, f"{root}/log", f"{root}/checkpoint", steps.newest_changes, once=True).awaitTermination()
    current = steps.newest_changes(jobs.read_batches(spark, f"{root}/log"))
    assert same(latest_corrections(df), current.select("original_pitch_uid", "field", "new_value"))


def test_restart_keeps_each_pitch_once(spark):
    root = new_run_dir(spark, "restart")
    first = frame(spark, [pitch(999777, pitcher_id=806000 + i, pitch_number=i) for i in range(3)], position=True)
    second = frame(spark, [pitch(999777, 1, pitcher_id=806100 + i, pitch_number=10 + i) for i in range(3)], position=True)
    for part in (first, second):
        drop_files(part, f"{root}/in", [F.lit(True)])
        stream = sources.read_files(spark, f"{root}/in", first.schema)
        jobs.append_bronze(stream, f"{root}/bronze", f"{root}/checkpoint", once=True).awaitTermination()
    got = sorted(r["pitcher_id"] for r in spark.read.parquet(f"{root}/bronze").collect())
    assert got == [806000, 806001, 806002, 806100, 806101, 806102]


def test_windows_close_at_the_watermark_and_bronze_keeps_late_rows(spark):
    root = new_run_dir(spark, "windows")
    batches = [
        [pitch(minute=m, pitch_number=m) for m in range(12)],
        [pitch(minute=1, pitch_number=50), pitch(minute=30, pitch_number=51)],
        [pitch(minute=31, pitch_number=52)],
    ]
    for rows in batches:
        df = frame(spark, rows, position=True)
        drop_files(df, f"{root}/in", [F.lit(True)])
        stream = sources.read_files(spark, f"{root}/in", df.schema)
        jobs.wait_all(jobs.start_smoke_job(stream, root, once=True))
    counts = spark.read.parquet(f"{root}/counts").collect()
    assert sum(r["pitch_count"] for r in counts) == 12
    assert jobs.read_batches(spark, f"{root}/bronze").count() == 15
    assert jobs.read_batches(spark, f"{root}/arrivals").columns == ["pitcher_id", "event_time"]


def test_file_position(spark):
    root = new_run_dir(spark, "position")
    df = frame(spark, [pitch(pitch_number=i) for i in range(5)])
    drop_files(df, f"{root}/in", [F.lit(True)])
    stream = sources.with_file_position(sources.read_files(spark, f"{root}/in", PITCH))
    jobs.append_bronze(stream, f"{root}/bronze", f"{root}/checkpoint", once=True).awaitTermination()
    got = spark.read.parquet(f"{root}/bronze").collect()
    assert sorted(r["source_offset"] for r in got) == [0, 1, 2, 3, 4]
    assert len({r["kafka_partition"] for r in got}) == 1


def test_print_sink(spark):
    root = new_run_dir(spark, "print")
    drop_files(frame(spark, [pitch()]), f"{root}/in", [F.lit(True)])
    stream = sources.read_files(spark, f"{root}/in", PITCH)
    run = jobs.print_rows(jobs.arrival_rows(stream), f"{root}/checkpoint", once=True)
    run.awaitTermination()
    assert run.exception() is None and sum(p["numInputRows"] for p in run.recentProgress) == 1
