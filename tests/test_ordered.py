"""Cut groups against brute force in Python."""

import random

import pytest
from pyspark.sql import functions as F

from dualpath.operators import ordered
from dualpath.operators.ordered import OrderedGroups, find_hot_groups

WIDTH = 6


def rows(seed):
    """One key holds most rows; its slots come in clumps, so some segments are thin."""
    rng = random.Random(seed)
    out = []
    for key, n in (("hot", 400), ("b", 30), ("c", 1), ("warm", 120)):
        at = 0
        for _ in range(n):
            at += rng.choice([1, 1, 1, 50])
            out.append((key, at, rng.choice([None, rng.randint(0, 90)])))
    rng.shuffle(out)
    return out


def grouped(data):
    groups = {}
    for k, s, v in sorted(data, key=lambda r: r[1]):
        groups.setdefault(k, []).append((s, v))
    return groups


@pytest.mark.parametrize("seed, broadcast", [(1, 9), (2, 9), (3, 0)])
@pytest.mark.parametrize("limit", [8, 45, 10_000])
def test_frames_and_running(spark, monkeypatch, seed, broadcast, limit):
    monkeypatch.setattr(ordered, "BROADCAST_KEYS", broadcast)
    data = [(None if k == "warm" else k, s, v) for k, s, v in rows(seed)]
    df = spark.createDataFrame(data, "k string, s long, v long")
    spark.conf.set("spark.dualpath.measureBytes", "0")
    hot = find_hot_groups(df, ["k"], max_rows=limit)
    spark.conf.unset("spark.dualpath.measureBytes")
    assert (hot is None) == (limit == 10_000)
    groups = OrderedGroups(("k",), (F.asc("s"),), hot)
    got = groups.running(
        groups.split(df),
        {"n": ("count", None), "total": ("sum", F.col("v")), "top": ("max", F.col("v")), "seen": ("last", F.col("v"))},
    )
    got = groups.frames(
        got,
        WIDTH - 1,
        lambda w: {
            "recent": F.sum("v").over(w.rowsBetween(1 - WIDTH, 0)),
            "before": F.lag("s").over(w),
        },
    )
    got = groups.means_of(got, {"start": F.col("v")}, F.col("n") <= 5)
    got = groups.maxima_of(got, {"most": F.col("v")}).merged()
    got = {(r["k"], r["s"]): r for r in got.collect()}
    assert len(got) == len(data)
    for k, seq in grouped(data).items():
        firsts = [v for _, v in seq[:5] if v is not None]
        for i, (s, _) in enumerate(seq):
            so_far = [v for _, v in seq[: i + 1] if v is not None]
            near = [v for _, v in seq[max(0, i - WIDTH + 1) : i + 1] if v is not None]
            r = got[k, s]
            assert r["n"] == i + 1
            assert r["most"] == max((v for _, v in seq if v is not None), default=None)
            assert r["total"] == (sum(so_far) if so_far else None)
            assert r["top"] == (max(so_far) if so_far else None)
            assert r["seen"] == (so_far[-1] if so_far else None)
            assert r["recent"] == (sum(near) if near else None)
            assert r["before"] == (seq[i - 1][0] if i else None)
            assert r["start"] == (pytest.approx(sum(firsts) / len(firsts)) if firsts else None)


def test_many_rows_of_one_first_order_value(spark, hot):
    df = spark.range(300).select(F.lit("k").alias("k"), F.lit(7).cast("long").alias("s"), F.col("id").alias("v"))
    groups = OrderedGroups(("k",), (F.asc("s"), F.asc("v")), find_hot_groups(df, ["k"]))
    got = groups.running(df, {"n": ("count", None)})
    assert got.where("n != v + 1").count() == 0


def test_small_input_is_not_measured(spark):
    df = spark.createDataFrame([("a", 1)], "k string, s long")
    assert find_hot_groups(df, ["k"], max_rows=1) is None


@pytest.mark.parametrize(
    "name, exchanges, joins", [("pitcher_game_window", 1, 0), ("stg_pitches", 2, 1), ("signal_delta", 3, 2)]
)
def test_plain_plans_shuffle_each_input_once(spark, name, exchanges, joins):
    from checks.queries import QUERIES
    from conftest import SF_DIR

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == exchanges == plan.count("Exchange ")
    assert plan.count("SortMergeJoin") == joins
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan


def test_rows_without_an_order_value_come_last_when_cut(spark, hot):
    df = spark.range(101).select(F.lit("k").alias("k"), F.expr("if(id < 100, id, null)").alias("s"))
    order = (F.asc_nulls_last("s"),)
    got = OrderedGroups(("k",), order, find_hot_groups(df, ["k"])).running(df, {"n": ("count", None)})
    assert got.where("n != coalesce(s, 100) + 1").count() == 0
