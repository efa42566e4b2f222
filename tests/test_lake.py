import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import START, frame, pitch
from dualpath.plans import incremental
from dualpath.plans.features import pitcher_game_window
from dualpath.plans.staging import staged_pitches
from dualpath.schemas import CORRECTION
from dualpath.session import new_run_dir, shared_dir
from dualpath.sources.lake import Lake, day_range, iceberg_conf


@pytest.fixture
def lake(spark):
    made = Lake(spark, new_run_dir(spark, "lake"), "_" + uuid.uuid4().hex)
    made.create_namespaces()
    made.create_namespaces()
    return made


def test_old_snapshot_does_not_see_new_rows(spark, lake):
    df = frame(spark, [pitch(5, i, pitcher_id=i, pitch_number=i) for i in range(4)])
    lake.ensure_snapshot_table("bronze.pitches", df.schema)
    assert lake.current_snapshot("bronze.pitches") is None and lake.count_rows("bronze.pitches") == 0
    lake.commit(df.limit(0), "bronze.pitches")
    lake.commit(df, "bronze.pitches")
    assert lake.current_snapshot("bronze.pitches") == 1
    text = (
        "SELECT count(*), count(DISTINCT pitcher_id), count(DISTINCT pitch_number) FROM bronze_pitches "
        "WHERE game_pk = 5"
    )
    assert tuple(lake.query_snapshot(text, "bronze.pitches", 0, "bronze_pitches").first()) == (0, 0, 0)
    assert tuple(lake.query(text, {"bronze_pitches": "bronze.pitches"}).first()) == (4, 4, 4)
    assert lake.count_rows("bronze.pitches", "pitcher_id > 1") == 2


def test_repeating_a_commit_replaces_it(spark, lake):
    df = frame(spark, [pitch()])
    lake.ensure_snapshot_table("bronze.pitches", df.schema)
    for _ in range(2):
        lake.commit(df, "bronze.pitches", 0)
    assert lake.count_rows("bronze.pitches") == 1


def test_recreate_needs_confirmation(spark, lake):
    df = frame(spark, [pitch()])
    lake.ensure_snapshot_table("bronze.pitches", df.schema)
    lake.commit(df, "bronze.pitches")
    with pytest.raises(ValueError):
        lake.recreate("bronze.pitches", df.schema)
    lake.recreate("bronze.pitches", df.schema, confirm=True)
    assert lake.count_rows("bronze.pitches") == 0


def test_time_bounds_prune_days(spark, lake):
    rows = [pitch(1, 1440 * d, pitch_number=d) for d in range(5)]
    df = frame(spark, rows)
    lake.ensure_snapshot_table("bronze.pitches", df.schema)
    lake.commit(df, "bronze.pitches")
    day = START + datetime.timedelta(days=2)
    got = lake.read("bronze.pitches").where(day_range(day, day + datetime.timedelta(days=1)))
    assert got.count() == 1
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "event_day" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_iceberg_conf_names_the_catalog():
    assert iceberg_conf("lake", "u", "w")["spark.sql.catalog.lake.type"] == "rest"


def test_shared_dir_is_the_session_setting(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def log(game, n, start=0, **over):
    return [
        pitch(game, m, at_bat_number=m // 5 + 1, pitch_number=m % 5 + 1, release_speed=90 + m % 9 * 0.7, **over)
        for m in range(start, start + n)
    ]


def test_incremental_refresh_equals_full(spark, lake):
    """Rows that continue a game, come late into an old one, correct one, or start new games beside old ones."""
    empty = spark.createDataFrame([], CORRECTION)
    later = START + datetime.timedelta(days=1)
    late = [{**r, "ingest_time": later, "release_speed": 70.0} for r in log(1, 2, 3)]
    loads = [
        (log(1, 30) + log(2, 30) + log(3, 8) + log(7, 12), empty),
        (log(3, 25, 8) + late + log(4, 10), empty),
        (log(9, 10), spark.createDataFrame([(later, later, 2, "2:1:2", "pitch_type", "FF", "SI")], CORRECTION)),
    ]
    schema = frame(spark, [pitch()], position=True).schema
    lake.ensure_snapshot_table("bronze.pitches", schema)
    lake.ensure_snapshot_table("bronze.corrections", CORRECTION)
    incremental.ensure_window_table(lake, "silver.windows")
    for n, (rows, fixes) in enumerate(loads):
        lake.commit(frame(spark, rows, position=True), "bronze.pitches", n)
        lake.commit(fixes, "bronze.corrections", n)
        incremental.refresh(
            lake, "bronze.pitches", "bronze.corrections", "silver.windows", n - 1 if n else None, games_per_part=4
        )
        got = lake.read_plain("silver.windows").drop("game_part")
        full = pitcher_game_window(staged_pitches(lake.read("bronze.pitches"), lake.read("bronze.corrections")))
        full = full.select(*got.columns)
        assert got.count() == full.count() == got.dropDuplicates(["game_pk", "at_bat_number", "pitch_number"]).count()
        assert full.exceptAll(got).count() == 0
    assert got.where(F.col("game_pk") == 9).count() == 10


def test_a_shorter_retry_of_a_commit_leaves_nothing_behind(spark, lake):
    days = [pitch(pitch_number=i, event_time=START + datetime.timedelta(days=i)) for i in range(3)]
    df = frame(spark, days)
    lake.ensure_snapshot_table("bronze.pitches", df.schema)
    lake.commit(df, "bronze.pitches", 0)
    lake.commit(df.limit(1), "bronze.pitches", 0)
    assert lake.count_rows("bronze.pitches") == 1 and lake.snapshots("bronze.pitches").count() == 1
