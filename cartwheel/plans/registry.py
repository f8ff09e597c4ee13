"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame``
plus, where the operator is SQL-expressible, the DuckDB oracle text.

Double columns of queries with an oracle are rounded to ``DIGITS`` decimals on
both sides so that different (but equally correct) summation orders hash the
same; queries without an oracle return doubles as computed."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


@dataclass
class Entry:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    doubles: list[str] = field(default_factory=list)
    ids: str = ""
    digits: dict[str, int] = field(default_factory=dict)


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, doubles: list[str] | tuple = (), ids: str = "",
             digits: dict[str, int] | None = None):
    """``digits`` overrides the rounding of single columns (e.g. money totals
    of 1e9 and more are reported in cents)."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, list(doubles), ids, dict(digits or {}))
        return fn
    return deco


# |scaled - tie| below 1e-9 + 1e-12 * |scaled| (capped at 0.01) counts as a tie:
# far above float summation noise (~1e-15 relative), far below a rounding unit.
TIE_TOLERANCE, TIE_RELATIVE, TIE_CAP = 1e-9, 1e-12, 0.01


def tie_safe_round(x, digits: int):
    """Round to ``digits`` decimals, half away from zero, where a scaled value
    within a tiny tolerance of a .5 tie counts as the tie. Two
    engines whose sums differ by a few ulps therefore agree even on values that
    are exact decimal ties (e.g. averages of 2-decimal prices); the oracle
    side applies the same rule (``tie_safe_round_sql``)."""
    m = F.lit(float(10 ** digits))
    r = x * m
    fl = F.floor(r)
    tol = F.least(F.lit(TIE_TOLERANCE) + F.lit(TIE_RELATIVE) * F.abs(r), F.lit(TIE_CAP))
    near_tie = F.abs((r - fl) - F.lit(0.5)) <= tol
    return F.when(near_tie, F.when(r >= 0, fl + F.lit(1.0)).otherwise(fl)).otherwise(F.round(r)) / m


def tie_safe_round_sql(c: str, digits: int) -> str:
    m = f"{float(10 ** digits)!r}"
    r = f"({c} * {m})"
    tol = f"least({TIE_TOLERANCE!r} + {TIE_RELATIVE!r} * abs({r}), {TIE_CAP!r})"
    return (f"(CASE WHEN abs(({r} - floor({r})) - 0.5) <= {tol} "
            f"THEN (CASE WHEN {r} >= 0 THEN floor({r}) + 1.0 ELSE floor({r}) END) ELSE round({r}) END / {m})")


def round_doubles(df: DataFrame, digits: int = DIGITS, per_col: dict[str, int] | None = None) -> DataFrame:
    cols = []
    per_col = per_col or {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(tie_safe_round(F.col(f.name).cast("double"), per_col.get(f.name, digits)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def spark_query(e: Entry) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = e.build(spark, sf_dir)
        # rounding serves the comparison with the oracle; results without one stay as computed
        return round_doubles(out, per_col=e.digits) if e.sql else out
    run.__name__ = e.name
    return run


def oracle_text(e: Entry) -> str:
    body = e.sql.strip().rstrip(";")
    if not e.doubles:
        return body
    rep = ", ".join(f"{tie_safe_round_sql(c, e.digits.get(c, DIGITS))} AS {c}" for c in e.doubles)
    return f"SELECT * REPLACE ({rep}) FROM (\n{body}\n) AS _q"
