"""Column-level semantics decided once (pandas-compatible where it matters).

* NaN never enters a frame: missing is NULL.
* ``sum`` of nothing is 0 (pandas) -> ``zsum``.
* ``Timedelta.days`` floors (-5 h -> -1 day) -> ``floor_days``.
* ``log1p`` of <= -1 or NULL is 0 after the reference's inf/NaN clean-up.
* Durations on TIMESTAMP_NTZ go through ``timestampdiff(MICROSECOND, ..)``.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros_between(start, end) -> Column:
    """end - start in microseconds (works for TIMESTAMP and TIMESTAMP_NTZ)."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end))


def floor_days(start, end) -> Column:
    """pandas ``(end - start).dt.days``: floor of whole days, as long."""
    return F.floor(micros_between(start, end) / F.lit(MICROS_PER_DAY)).cast("long")


def frac_days(start, end) -> Column:
    """``(end - start).total_seconds() / 86400``."""
    return micros_between(start, end) / F.lit(float(MICROS_PER_DAY))


def total_seconds(start, end) -> Column:
    return micros_between(start, end) / F.lit(float(MICROS_PER_SECOND))


def whole_seconds(start, end) -> Column:
    """``timedelta64[s]`` cast: truncation toward zero to whole seconds."""
    us = micros_between(start, end)
    return F.when(us >= 0, F.floor(us / F.lit(MICROS_PER_SECOND))).otherwise(
        F.ceil(us / F.lit(MICROS_PER_SECOND))).cast("double")


def add_days(ts, days) -> Column:
    return col(ts) + F.make_dt_interval(F.lit(days))


def log1p0(x) -> Column:
    """``log1p`` with -inf/NaN/NULL mapped to 0 (Spark's log1p(<=-1) is NULL)."""
    x = col(x)
    return F.coalesce(F.when(x > -1, F.log1p(x)), F.lit(0.0))


def zsum(x) -> Column:
    """pandas sum: NULLs skipped, empty -> 0."""
    return F.coalesce(F.sum(col(x)), F.lit(0))


def safe_div(a, b) -> Column:
    return F.try_divide(col(a), col(b))


def flag(cond: Column) -> Column:
    return cond.cast("int")


def row_sum(cols) -> Column:
    return reduce(add, [col(c) for c in cols])


def clip_lower(x, lo) -> Column:
    return F.greatest(col(x), F.lit(lo))


def rnd(x, digits: int = 6) -> Column:
    """Rounding used in reported numeric outputs (both sides of oracle checks)."""
    return F.round(col(x), digits)
