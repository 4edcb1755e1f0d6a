"""Integer arithmetic with the truncating, saturating rules the metrics use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MIN = -2147483648
INT_MAX = 2147483647


def saturating_int(value: Column) -> Column:
    """Double to INT: fraction cut off, out-of-range clamped, NaN and null 0."""
    known = F.coalesce(F.nanvl(value.cast("double"), F.lit(0.0)), F.lit(0.0))
    clamped = F.least(F.greatest(known, F.lit(float(INT_MIN))), F.lit(float(INT_MAX)))
    return clamped.cast("int")


def truncated_mean(total: Column, count: Column) -> Column:
    """Integer mean cut towards zero, clamped to INT; sums stay BIGINT."""
    mean = F.call_function("div", total, count)
    return F.least(F.greatest(mean, F.lit(INT_MIN)), F.lit(INT_MAX)).cast("int")


def millis(ts: Column) -> Column:
    return F.unix_millis(ts)
