"""Scores, bands and display values as column arithmetic."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from dualpath.functions.numbers import clamp01, rounded

# What counts as a full loss of each component, and the zone share that counts as good.
VELOCITY_SPAN = 3.5
SPIN_SPAN = 200.0
GOOD_ZONE_SHARE = 0.68
ZONE_SPAN = 0.3
FULL_PITCH_COUNT = 110.0
LEVERAGE_DISPLAY_SCALE = 3.5

# Severity bands, lowest score of each.
BANDS = {"info": 0.40, "warning": 0.55, "action": 0.70}
RANK = {"info": 1, "warning": 2, "action": 3}


@dataclass(frozen=True)
class Weights:
    """Calibrated weights and the version that alerts carry."""

    # The published default weights.
    velocity: float = 0.30
    spin: float = 0.20
    command: float = 0.20
    pitch_count: float = 0.30
    model_version: str = "fatigue_v1.0"


@dataclass(frozen=True)
class Composite:
    """How the three signals mix into one score; the mix is a parameter."""

    fatigue: float = 0.6
    leverage: float = 0.3
    matchup: float = 0.1


def velocity_component(mean: Column, baseline: Column) -> Column:
    return clamp01(-(mean - baseline) / VELOCITY_SPAN)


def spin_component(mean: Column, baseline: Column) -> Column:
    return clamp01(-(mean - baseline) / SPIN_SPAN)


def command_component(zone_share: Column) -> Column:
    return clamp01((F.lit(GOOD_ZONE_SHARE) - zone_share) / ZONE_SPAN)


def pitch_count_component(idx: Column) -> Column:
    return F.least(F.lit(1.0), idx / F.lit(FULL_PITCH_COUNT))


def fatigue_score(velocity: Column, spin: Column, command: Column, count: Column, w: Weights) -> Column:
    """Weighted sum; a component that cannot be computed adds nothing."""
    zero = F.lit(0.0)
    return (
        F.lit(w.velocity) * F.coalesce(velocity, zero)
        + F.lit(w.spin) * F.coalesce(spin, zero)
        + F.lit(w.command) * F.coalesce(command, zero)
        + F.lit(w.pitch_count) * count
    )


def leverage_by_pitch(idx: Column) -> Column:
    """Rises slowly to pitch 50, faster to 80, fastest after."""
    return (
        F.when(idx < 50, F.lit(0.8) + idx / F.lit(200.0))
        .when(idx < 80, F.lit(1.1) + (idx - 50) * F.lit(0.02))
        .otherwise(F.lit(1.7) + (idx - 80) * F.lit(0.08))
    )


def matchup_from_fatigue(fatigue: Column) -> Column:
    """Takes the unrounded fatigue."""
    return F.lit(-0.020) + (fatigue - F.lit(0.4)) * F.lit(0.08)


def composite_score(fatigue: Column, leverage: Column, matchup: Column, mix: Composite) -> Column:
    scaled = clamp01(leverage / LEVERAGE_DISPLAY_SCALE)
    tilt = clamp01((matchup + 0.1) / 0.2)
    return rounded(
        F.lit(mix.fatigue) * fatigue + F.lit(mix.leverage) * scaled + F.lit(mix.matchup) * tilt, 3
    )


def severity(score: Column) -> Column:
    return (
        F.when(score >= BANDS["action"], "action")
        .when(score >= BANDS["warning"], "warning")
        .when(score >= BANDS["info"], "info")
    )


def severity_rank(name: Column) -> Column:
    return (
        F.when(name == "action", RANK["action"])
        .when(name == "warning", RANK["warning"])
        .when(name == "info", RANK["info"])
        .otherwise(0)
    )


def band_floor(name: Column) -> Column:
    floors = F.create_map(*[x for k, v in BANDS.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(floors, name)


def canonical_shift(fatigue: Column, idx: Column) -> Column:
    """The display's stand-in for a canonical curve: higher after pitch 70, a little lower before."""
    return rounded(F.when(idx > 70, fatigue + 0.03).otherwise(fatigue - 0.01), 3)


def milli_delta(canonical: Column, streaming: Column) -> Column:
    """canonical - streaming of values with three digits, without float residue."""
    unit = F.lit(1000.0)
    whole = F.round(canonical * unit).cast("bigint") - F.round(streaming * unit).cast("bigint")
    return whole / unit


def delta_class(delta: Column) -> Column:
    return F.when(delta >= 0, "positive").otherwise("negative")


def signed_text(value: Column) -> Column:
    return F.format_string("%+.3f", value)


def scheduled_position(idx: Column) -> dict[str, Column]:
    """Inning, at-bat and pitch of the n-th pitch on the display's fixed schedule."""
    at = idx - 1
    return {
        "scheduled_inning": F.least(F.floor(at / 15) + 1, F.lit(7)).cast("int"),
        "scheduled_at_bat": (F.floor(at / 4) + 1).cast("int"),
        "scheduled_pitch": (at % 4 + 1).cast("int"),
    }


def scheduled_time(first_pitch: Column, idx: Column) -> Column:
    return first_pitch + F.make_dt_interval(secs=idx * 25)
