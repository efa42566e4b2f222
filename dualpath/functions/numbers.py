"""Sums that do not depend on row order, so every partitioning gives the same mean."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICRO = 1_000_000


def micros(c: Column) -> Column:
    """A double as whole millionths, for sums over frames of a few rows."""
    return F.round(c * F.lit(float(MICRO))).cast("bigint")


def frame_mean(c: Column, window) -> Column:
    """Mean over a bounded row frame; NULLs are skipped."""
    m = micros(c)
    return F.sum(m).over(window) / (F.count(m).over(window) * F.lit(float(MICRO)))


def group_mean(c: Column) -> Column:
    """Mean over a group of any size: the exact decimal sum has room for 10^22 units."""
    return F.sum(c.cast("decimal(18,6)")).cast("double") / F.count(c)


def share(flag: Column, window) -> Column:
    """Share of true flags in a frame."""
    n = F.count(F.lit(1)).over(window)
    return F.sum(F.coalesce(flag, F.lit(False)).cast("bigint")).over(window) / n


def clamp01(c: Column) -> Column:
    """Clamp to [0, 1]; unlike greatest/least alone, NULL stays NULL."""
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)))


def rounded(c: Column, digits: int) -> Column:
    """Round half up on the double itself, the same on every engine; never gives -0.0."""
    unit = F.lit(float(10**digits))
    return F.floor(c * unit + F.lit(0.5)).cast("double") / unit
