"""Numeric, date and hash expressions with pinned null rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNKNOWN = "unknown"


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Clamp to ``[low, high]``; null stays null (greatest/least would skip it)."""
    out = value
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return F.when(value.isNotNull(), out)


def log_amount(value: Column) -> Column:
    return F.log1p(clip(value.cast("double"), low=0))


def to_number(value: Column, default: float = 0) -> Column:
    """Number or ``default``; text that is no number counts as missing."""
    return F.coalesce(value.try_cast("double"), F.lit(float(default)))


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def logit(p: Column) -> Column:
    return F.ln(p / (F.lit(1.0) - p))


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, and 0 where nothing is there to divide by."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def parse_time(text: Column) -> Column:
    """Timestamp, or null where the text is no date (ANSI casts would raise)."""
    return F.try_to_timestamp(text.cast("string"))


def days_between(start: Column, end: Column) -> Column:
    """Fractional days from ``start`` to ``end``."""
    return F.timestamp_diff("MICROSECOND", start, end).cast("double") / F.lit(86400e6)


def year_level(ts: Column) -> Column:
    return F.coalesce(F.year(ts).cast("string"), F.lit(UNKNOWN))


def month_level(ts: Column) -> Column:
    return F.coalesce(F.month(ts).cast("string"), F.lit(UNKNOWN))


def weekday_level(ts: Column) -> Column:
    """Monday is 0."""
    return F.coalesce(F.weekday(ts).cast("string"), F.lit(UNKNOWN))


def hash_prefix(key: Column, digits: int = 8) -> Column:
    """First hex digits of the md5 of ``key`` as a number."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, digits), 16, 10).cast("long")


def unit_hash(key: Column) -> Column:
    """Deterministic number in [0, 1) from a string key."""
    return hash_prefix(key.cast("string")).cast("double") / F.lit(4294967296.0)
