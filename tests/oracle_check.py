"""Local stand-in for the driver's correctness gate: run each registered
Spark query and its DuckDB oracle on the same parquet tables and compare
row count, column names and order-insensitive values."""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            v = v.item()
        except Exception:  # noqa: BLE001
            pass
    if isinstance(v, pd.Timestamp):
        return v.value
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).value
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def frame_key(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, isinstance(x, str), round(x, 4) if isinstance(x, float) else (x if x is not None else 0)) for x in r))


def compare(spark_df: pd.DataFrame, oracle_df: pd.DataFrame) -> str | None:
    if sorted(spark_df.columns) != sorted(oracle_df.columns):
        return f"columns differ: {sorted(spark_df.columns)} vs {sorted(oracle_df.columns)}"
    if len(spark_df) != len(oracle_df):
        return f"rows differ: {len(spark_df)} vs {len(oracle_df)}"
    c1, r1 = frame_key(spark_df)
    c2, r2 = frame_key(oracle_df)
    for a, b in zip(r1, r2):
        if not all(_eq(x, y) for x, y in zip(a, b)):
            return f"value differ: {a} vs {b}"
    return None


def _eq(x, y):
    if isinstance(x, float) and isinstance(y, (float, int)) or isinstance(y, float) and isinstance(x, (float, int)):
        return math.isclose(float(x), float(y), rel_tol=1e-9, abs_tol=1e-9)
    return x == y


def run(names=None, sf_dir="/root/testdata/sf0.01"):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as ent
    from cartwheel.session import build_session
    spark = build_session()
    qs, sqls = ent.queries(), ent.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or sorted(qs)):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir).toPandas()
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(ex)[:400]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in sqls:
            print(f"rows {name}: {len(sdf)} rows ({t1 - t0:.1f}s)")
            continue
        try:
            odf = con.execute(sqls[name]).df()
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {name}: oracle error {str(ex)[:400]}")
            bad += 1
            continue
        err = compare(sdf, odf)
        print(("OK  " if err is None else "FAIL") + f" {name}: {len(sdf)} rows ({t1 - t0:.1f}s) {err or ''}")
        bad += err is not None
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf, args = args[0], args[1:]
    sys.exit(1 if run(args or None, sf) else 0)
