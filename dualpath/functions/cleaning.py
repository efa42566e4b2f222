"""Lenient parsing of raw pitch columns. Native expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_inning(c: Column) -> Column:
    """Text that starts with "top" in any case is Top; all else, NULL included, is Bot."""
    starts = F.startswith(F.lower(F.coalesce(c.cast("string"), F.lit(""))), F.lit("top"))
    return F.when(starts, F.lit("Top")).otherwise(F.lit("Bot"))


def lenient_double(c: Column) -> Column:
    """NULL for unreadable text and NaN."""
    return F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))


def lenient_int(c: Column) -> Column:
    """Truncates toward zero; NULL for unreadable text, NaN and infinity."""
    return lenient_double(c).try_cast("int")


def lenient_long(c: Column) -> Column:
    return lenient_double(c).try_cast("bigint")


def clean_text(c: Column) -> Column:
    """Trim whitespace; empty text and "nan" in any case become NULL."""
    trimmed = F.btrim(c.cast("string"), F.lit(" \t\n\r\f\x0b"))
    return F.when(~F.lower(trimmed).isin("", "nan"), trimmed)
