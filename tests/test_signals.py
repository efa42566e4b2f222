"""The 98-pitch fatigue arc and the reconciliation classes."""

import datetime

import pytest

from conftest import START, frame, pitch
from dualpath.functions.scores import BANDS
from dualpath.plans import marts, reconcile, signals
from dualpath.plans.features import with_pace


def arc():
    """Inputs of the arc by its published rules."""
    out = []
    for i in range(1, 99):
        if i <= 20:
            velo, spin, zone = 94.6 - (i % 3) * 0.15, 2310 + (i % 4) * 8, i % 7 != 0
        elif i <= 60:
            velo, spin, zone = 94.1 - (i - 20) * 0.01 - (i % 3) * 0.2, 2300 - (i - 20) * 0.5, i % 5 != 0
        elif i <= 85:
            velo, spin, zone = 93.0 - (i - 60) * 0.04 - (i % 3) * 0.3, 2270 - (i - 60) * 3.5, i % 3 != 0
        else:
            velo, spin, zone = 91.8 - (i - 85) * 0.08, 2130 - (i - 85) * 4, i % 2 == 0
        out.append((i, round(velo, 1), float(round(spin)), 5 if zone else 12))
    return out


@pytest.fixture(scope="module")
def snapshots(spark):
    rows = [
        pitch(minute=i, at_bat_number=i, release_speed=v, release_spin_rate=s, zone=z) for i, v, s, z in arc()
    ]
    features = signals.canonical_features(frame(spark, rows))
    return {r["pitch_idx"]: r for r in signals.signal_snapshots(features).collect()}


# Fixed values: (fatigue, velocity, spin, command, leverage, matchup) at five pitches.
GOLDEN = {
    20: (0.055, 0.0, 0.0, 0.0, 0.90, -0.048),
    58: (0.267, 0.239, 0.186, 0.0, 1.26, -0.031),
    78: (0.520, 0.607, 0.444, 0.183, 1.66, -0.010),
    92: (0.684, 0.782, 0.808, 0.183, 2.66, 0.003),
    98: (0.811, 0.884, 1.000, 0.392, 3.14, 0.013),
}


@pytest.mark.parametrize("idx", sorted(GOLDEN))
def test_golden_arc(snapshots, idx):
    r = snapshots[idx]
    got = (
        r["fatigue"],
        r["fatigue_velocity_component"],
        r["fatigue_spin_component"],
        r["fatigue_command_component"],
        r["leverage"],
        r["matchup_edge"],
    )
    assert got == pytest.approx(GOLDEN[idx], abs=1e-9)


def test_arc_crossings(snapshots):
    assert len(snapshots) == 79
    first = {b: min(i for i, r in snapshots.items() if r["fatigue"] >= t) for b, t in BANDS.items()}
    assert first == {"info": 72, "warning": 84, "action": 93}


def test_whole_arc_equals_python_rounding(snapshots):
    data = arc()
    base_v = sum(v for _, v, _, _ in data[:20]) / 20
    base_s = sum(s for _, _, s, _ in data[:20]) / 20
    clamp = lambda x: max(0.0, min(1.0, x))
    for i, r in snapshots.items():
        last = data[max(0, i - 16) : i]
        n = len(last)
        v = clamp(-(sum(x[1] for x in last) / n - base_v) / 3.5)
        s = clamp(-(sum(x[2] for x in last) / n - base_s) / 200)
        c = clamp((0.68 - sum(x[3] <= 9 for x in last) / n) / 0.3)
        assert r["fatigue"] == round(0.3 * v + 0.2 * s + 0.2 * c + 0.3 * min(1.0, i / 110), 3), i


STATE = "event_time timestamp, game_pk long, pitcher_id long, at_bat_number int, pitch_number int, composite double"


def states(spark, values):
    rows = [(START, 1, 9, i, 1, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, STATE)


def alert(i, severity, score):
    return (1, 9, i, 1, f"a{i}", severity, score)


ALERT = (
    "game_pk long, pitcher_id long, at_bat_number int, pitch_number int, alert_uid string, severity string, score double"
)


def test_outcome_classes(spark):
    streaming = [0.41, 0.60, 0.72, 0.58, 0.45, 0.75, 0.38, 0.36]
    canonical = [0.42, 0.75, 0.50, 0.30, 0.39, 0.30, 0.41, 0.20]
    alerts = [
        alert(0, "info", 0.41),
        alert(1, "warning", 0.60),
        alert(2, "action", 0.72),
        alert(3, "warning", 0.58),
        alert(4, "info", 0.45),
        alert(5, "action", 0.75),
    ]
    said = reconcile.said_by(spark.createDataFrame(alerts, ALERT), states(spark, streaming))
    got = reconcile.alert_reconciliation(said, states(spark, canonical)).collect()
    outcome = {r["at_bat_number"]: r["outcome"] for r in got}
    assert outcome == {
        0: "confirmed",
        1: "escalated",
        2: "softened",
        3: "reversed",
        4: "confirmed_late",
        5: "reversed",
        6: "suppressed_but_warranted",
    }


def test_pace_and_trend(spark):
    seconds = [0, 20, 41, 63, 86, 110]
    rows = [
        pitch(at_bat_number=i, event_time=START + datetime.timedelta(seconds=s)) for i, s in enumerate(seconds)
    ]
    got = with_pace(frame(spark, rows)).orderBy("at_bat_number").collect()
    assert [r["pace_seconds"] for r in got] == [None, 20.0, 21.0, 22.0, 23.0, 24.0]
    assert [r["pace_trend_last_10"] for r in got] == [None, None, 1.0, 1.0, 1.0, 1.0]


def test_removal_label(spark):
    pitchers = [1, 1, 1, 2, 2]
    rows = [pitch(minute=i, at_bat_number=i, pitcher_id=p) for i, p in enumerate(pitchers)]
    got = marts.removal_label(frame(spark, rows)).orderBy("at_bat_number").collect()
    assert [r["removed_soon"] for r in got] == [False, True, True, False, False]


def test_fit_finds_the_component_that_matters(spark, tmp_path):
    rows = [(i % 10 / 10, (i * 7 % 10) / 10, 0.5, 0.5, float(i % 10 > 5)) for i in range(400)]
    df = spark.createDataFrame(rows, [*marts.COMPONENTS, "label"])
    got = marts.fit_weights(df, "v9")
    assert got.model_version == "v9" and got.velocity > 0.8
    assert got.velocity + got.spin + got.command + got.pitch_count == pytest.approx(1.0)
    signals.save_weights(spark, got, str(tmp_path / "weights"))
    assert signals.load_weights(spark, str(tmp_path / "weights")) == got
