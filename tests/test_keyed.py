"""How rows reach a keyed state and what a stream's state is dealt by."""

import datetime

import pyarrow as pa
from pyspark.sql import functions as F

from conftest import START
from dualpath.streaming import jobs, keyed, live, sources


def test_rows_of_a_key_reach_the_state_as_one():
    rows = pa.table({"k": [2, None, 2, 1, None], "j": ["a", "b", "a", None, "b"], "x": [2**60 + 1, None, 3, 4, 5]})
    packed = pa.Table.from_batches(keyed._pack(["k", "j"])(iter(rows.to_batches())))
    assert len(packed) == 3 and packed.column_names == ["_key", "_rows"]
    assert set(packed.column("_key").to_pylist()) == {'[2, "a"]', '[null, "b"]', "[1, null]"}
    out = pa.Table.from_batches(keyed._unpack(iter(packed.select(["_rows"]).to_batches()))).to_pylist()
    assert sorted(map(str, out)) == sorted(map(str, rows.to_pylist()))


def test_state_partitions_follow_the_input(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/few")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        assert jobs.state_partitions(spark, f"{tmp_path}/few") == spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert jobs.state_partitions(spark, f"{tmp_path}/few") == 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_state_partition_is_worth_its_process(spark, tmp_path):
    (tmp_path / "some").mkdir()
    (tmp_path / "some" / "file").write_bytes(bytes(12 << 20))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        # A megabyte a partition would be 12.
        assert jobs.state_partitions(spark, f"{tmp_path}/some") == max(2, spark.sparkContext.defaultParallelism) < 12
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_loads_have_files_for_all_cores(spark, tmp_path):
    rows = spark.range(40_000).selectExpr("id event_id", "timestamp_ntz '2024-01-01 00:00:00' ts", "id user_id", "'view' event_type", "1.0D value", "string(id) props")
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        for _ in sources.append_events(spark, str(tmp_path), f"{tmp_path}/loads", 1):
            pass
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", before)
    got = spark.read.schema(sources.EVENTS).parquet(f"{tmp_path}/loads")
    assert sorted(got.collect()) == sorted(rows.collect())
    spans = got.groupBy(F.input_file_name()).agg(F.min("event_id").alias("a"), F.max("event_id").alias("z")).orderBy("a").collect()
    assert len(spans) > 1 and all(x["z"] < y["a"] for x, y in zip(spans, spans[1:]))


def test_signals_meet_within_a_slot_of_time(spark):
    minutes = lambda m: START + datetime.timedelta(minutes=m)
    rows = spark.createDataFrame([(g, minutes(m)) for g in (1, 2) for m in range(0, 300, 5)], "game_pk long, event_time timestamp")
    signal = spark.createDataFrame([(1, minutes(m), float(m)) for m in range(0, 300, 7)], "game_pk long, event_time timestamp, leverage double")
    out = live._latest_within(rows, signal, ["game_pk"], "leverage", "10 minutes")
    got = {(r["game_pk"], r["event_time"]): r["leverage"] for r in out.collect()}
    want = {(g, minutes(m)): float(m - m % 7) if g == 1 else None for g in (1, 2) for m in range(0, 300, 5)}
    assert got == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "slot" in plan[plan.index("Join LeftOuter") :].splitlines()[0]


def test_null_keys_are_one_key_beside_others(spark, tmp_path):
    rows = [(g, p, i) for i in range(3) for g in (1, 2) for p in (None, 10, 11)]
    df = spark.createDataFrame(rows, "game_pk long, pitcher_id long, i long")
    for part in ("i < 2", "i >= 2"):
        df.where(part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = sources.read_files(spark, f"{tmp_path}/in", df.schema)
        out = keyed.carry(stream, ["game_pk", "pitcher_id"], [F.col("i")], keyed.Running(index="nth", previous={"before": "i"}))
        jobs.append_files(out, f"{tmp_path}/out", f"{tmp_path}/checkpoint", once=True).awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()), key=str)
    assert got == sorted([(g, p, i, i + 1, i - 1 if i else None) for g, p, i in rows], key=str)
