"""Scalar expressions, all built-in and code-generated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper ends and names of the sequence length bins, and the name above them.
LENGTH_BINS = (
    (100, "0000_0100"),
    (200, "0101_0200"),
    (500, "0201_0500"),
    (1000, "0501_1000"),
    (2000, "1001_2000"),
)
LONGEST_BIN = "2001_plus"


def number(column: Column) -> Column:
    """Lenient double: null for text that is no number, and for NaN."""
    value = column.try_cast("double")
    return F.when(~F.isnan(value), value)


def clip_unit(column: Column) -> Column:
    """Value limited to [0, 1]; null stays null."""
    return F.when(column.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), column)))


def strict_unit(column: Column) -> Column:
    """Double limited to [0, 1]; text that is no number fails the query, NaN counts as null."""
    value = column.cast("double")
    return clip_unit(F.when(~F.isnan(value), value))


def as_fraction(column: Column, default: float) -> Column:
    """Fraction from a fraction or a percentage: above 1 means percent; null gives ``default``."""
    value = F.coalesce(number(column), F.lit(float(default)))
    return clip_unit(F.when(value > 1.0, value / 100.0).otherwise(value))


def length_bin(column: Column) -> Column:
    """Name of the bin that a sequence length falls in; null counts as 0."""
    length = F.coalesce(column.cast("long"), F.lit(0))
    out = F.lit(LONGEST_BIN)
    for end, name in reversed(LENGTH_BINS):
        out = F.when(length <= end, F.lit(name)).otherwise(out)
    return out


def stable_hash(column: Column, seed: int) -> Column:
    """First 64 bits of SHA-1 of ``seed:value`` as 16 hex digits; they sort like the number."""
    return F.substring(F.sha1(F.concat_ws(":", F.lit(str(seed)), column.cast("string")).cast("binary")), 1, 16)


def thresholds(step: float) -> list[float]:
    """Evenly spaced score thresholds from 0 to 1, rounded to ten places."""
    if not 0 < step <= 1:
        raise ValueError("the threshold step must lie in (0, 1]")
    n = round(1 / step)
    return [round(k / n, 10) for k in range(n + 1)]
