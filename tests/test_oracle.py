"""Every registered query against its DuckDB oracle on the smallest data."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck
from conftest import SF_DIR

QUERIES, ORACLE = entry.QUERIES, entry.ORACLE

# Queries whose result has no SQL form; they have tests of their own.
NO_ORACLE: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) == []


def test_each_query_has_an_oracle():
    assert set(QUERIES) - set(ORACLE) == NO_ORACLE


def test_entry(spark):
    assert entry.entry(spark).count() == 1000


HOT = [
    "pitcher_game_window",
    "synth_event_time",
    "game_state_events",
    "late_split",
    "signals_provisional",
    "stream_features",
    "signals_canonical",
    "pace_trend",
    "alert_reconciliation",
    "removal_label",
    "splits_as_of",
    "incremental_equals_full",
    "resumed_late_rows",
]


@pytest.mark.parametrize("name", HOT)
def test_same_when_groups_are_cut(spark, con, hot, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) == []
