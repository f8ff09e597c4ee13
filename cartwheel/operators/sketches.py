"""A3, opt-in: approximate distinct counts that merge over any range of days.

A day's ids are kept as one HyperLogLog sketch; ranges of days merge sketches and
never read the events again. Exact counts stay the default everywhere else."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_REGISTERS = 14


def relative_error_bound(lg_registers: int = LG_REGISTERS, deviations: float = 4.0) -> float:
    """Bound of the relative error: ``deviations`` standard errors of 1.04 / sqrt(registers)."""
    return deviations * 1.04 / 2 ** (lg_registers / 2)


def daily_sketches(events: DataFrame, ident: str, time: str, keys: list[str] | None = None,
                   lg_registers: int = LG_REGISTERS) -> DataFrame:
    """(keys, day, sketch): one sketch of the ids of each day; null ids are not counted."""
    return events.groupBy(*(keys or []), F.to_date(time).alias("day")) \
        .agg(F.hll_sketch_agg(ident, lg_registers).alias("sketch"))


def merged_counts(sketches: DataFrame, groups: list[Column | str], name: str = "approx_distinct") -> DataFrame:
    """Distinct ids of each group of days, from the days' sketches."""
    return sketches.groupBy(*groups).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))


def trailing_counts(sketches: DataFrame, days: int, keys: list[str] | None = None,
                    name: str = "approx_distinct") -> DataFrame:
    """Distinct ids of the ``days`` calendar days up to each day that has a sketch.
    A day's sketch goes to the days it counts for: days x sketches, never events."""
    keys = keys or []
    present = sketches.select(*keys, "day").distinct()
    to = sketches.withColumn("day", F.explode(F.sequence("day", F.date_add("day", days - 1))))
    return merged_counts(to.join(present, keys + ["day"], "left_semi"), [*keys, "day"], name)
