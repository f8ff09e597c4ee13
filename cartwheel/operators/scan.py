"""Ordered scans: running counts, running sums and previous values of every row
within its key, by a sort over range partitions.

Rows are range-partitioned by (key, order), so a key with a third of all rows
spans many tasks, each of about equal size. Every task scans its sorted rows
batch by batch; where a key runs on from one partition into the next, the later
one adds what the borders hand on: one row per partition."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.session import staged_parquet

_PART, _HEAD, _TAIL = "_sc_part", "_sc_head", "_sc_tail"


def _same(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Elementwise equality, null equal to null."""
    eq = pc.fill_null(pc.equal(a, b), False)
    return pc.or_(eq, pc.and_(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


def _reset_cumsum(x: np.ndarray, starts: np.ndarray, carry: int) -> np.ndarray:
    """Cumulative sums that begin anew where ``starts`` is true; rows before the
    first start go on from ``carry``."""
    total = np.cumsum(x)
    before = np.concatenate([[0], total])
    first = np.flatnonzero(starts)
    group = np.cumsum(starts)  # 0: rows that continue the previous batch's key
    base = np.concatenate([[-carry], before[first]])
    return total - base[group]


def _scanner(key: str, sums: list[str], lags: list[str], names: dict[str, str]) -> object:
    """The task's scan. It marks the rows of the partition's first key (``_HEAD``: 1,
    and 2 on its first row) and the partition's last row (``_TAIL``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held = None
        last: dict = {}       # last key and lag values, as one-element arrays
        carry = dict.fromkeys(sums, 0)
        head = True           # still in the partition's first key

        def with_tail(b: pa.RecordBatch, final: bool) -> pa.RecordBatch:
            tail = np.zeros(b.num_rows, dtype=bool)
            tail[-1] = final
            return pa.RecordBatch.from_arrays([*b.columns, pa.array(tail)], names=[*b.schema.names, _TAIL])

        for b in batches:
            if not b.num_rows:
                continue
            k = b.column(key)
            first = not last
            before = pa.concat_arrays([last.get(key, k.slice(0, 1)), k.slice(0, len(k) - 1)])
            starts = ~_same(k, before)
            starts[0] |= first
            cols, out = list(b.columns), list(b.schema.names)
            for c in sums:
                x = pc.fill_null(b.column(c), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                run_sum = _reset_cumsum(x, starts, carry[c])
                carry[c] = int(run_sum[-1])
                cols.append(pa.array(run_sum))
                out.append(names[c])
            for c in lags:
                x = b.column(c)
                prev = pa.concat_arrays([last.get(c, pa.nulls(1, x.type)), x.slice(0, len(x) - 1)])
                cols.append(pc.if_else(pa.array(starts), pa.nulls(len(x), x.type), prev))
                out.append(names["lag:" + c])
            in_head = (head & (np.cumsum(starts) - int(first) == 0)).astype(np.int32)
            head = bool(in_head[-1])
            in_head[0] += first  # 2: the partition's first row
            cols += [pa.array(np.full(b.num_rows, part, dtype=np.int32)), pa.array(in_head)]
            last = {c: b.column(c).slice(len(k) - 1, 1) for c in [key, *lags]}
            if held is not None:
                yield with_tail(held, False)
            held = pa.RecordBatch.from_arrays(cols, names=[*out, _PART, _HEAD])
        if held is not None:
            yield with_tail(held, True)
    return run


def _handed_on(borders: list[dict], key: str, sums: list[str], lags: list[str]) -> list[tuple]:
    """What each partition's first key takes over from earlier partitions: (part,
    sums..., previous values...). ``borders`` holds the first and the last row of
    every partition, in order."""
    out = []
    total, before = dict.fromkeys(sums, 0), None
    for row in borders:
        if row[_HEAD] == 2:
            goes_on = before is not None and before[key] == row[key]
            if goes_on:
                out.append((row[_PART], *[total[c] for c in sums], *[before[c] for c in lags]))
            else:
                total = dict.fromkeys(sums, 0)
        if row[_TAIL]:
            # a last row still in the partition's first key adds to what came before
            total = {c: (total[c] if row[_HEAD] else 0) + row[c] for c in sums}
            before = row
    return out


def ordered_scan(df: DataFrame, key: str, order: list[str | Column], sums: dict[str, str] | None = None,
                 lags: dict[str, str] | None = None, position: str | None = None) -> DataFrame:
    """``df`` with, per row within ``key`` in ``order``: inclusive running sums of the
    integer columns ``sums`` (column -> new name; null counts 0), previous rows'
    values of the columns ``lags`` (column -> new name; null on a key's first row),
    and the row's number from 0 as ``position``. A null key is a key of its own.
    The sorted rows are staged once; rows of equal order come in any order."""
    sums, lags = dict(sums or {}), dict(lags or {})
    d = df
    if position:
        d = d.withColumn("_sc_one", F.lit(1).cast("long"))
        sums["_sc_one"] = "_sc_n"
    by = [F.col(f"`{key}`").asc_nulls_first(), *[F.col(c) if isinstance(c, str) else c for c in order]]
    types = {f.name: f.dataType for f in d.schema}
    added = [(n, T.LongType()) for n in sums.values()] + [(n, types[c]) for c, n in lags.items()] + \
        [(_PART, T.IntegerType()), (_HEAD, T.IntegerType()), (_TAIL, T.BooleanType())]
    schema = T.StructType([*d.schema, *[T.StructField(n, t) for n, t in added]])
    run = _scanner(key, list(sums), list(lags), sums | {"lag:" + c: n for c, n in lags.items()})
    done = staged_parquet(d.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(run, schema), "ordered-scan")

    # at most two rows per partition: its first and its last one
    needed = list(dict.fromkeys([key, *sums.values(), *lags]))
    ends = done.where((F.col(_HEAD) == 2) | F.col(_TAIL)).select(_PART, _HEAD, _TAIL, *[f"`{c}`" for c in needed])
    borders = sorted((r.asDict() for r in ends.collect()), key=lambda r: (r[_PART], r[_TAIL]))
    taken = _handed_on(borders, key, list(sums.values()), list(lags))
    change = {}
    if taken:
        fields = [("_sc_p", T.IntegerType())] + [(f"_sc_s{i}", T.LongType()) for i in range(len(sums))] + \
            [(f"_sc_l{i}", types[c]) for i, c in enumerate(lags)]
        over = df.sparkSession.createDataFrame(taken, T.StructType([T.StructField(n, t) for n, t in fields]))
        done = done.join(F.broadcast(over), (F.col(_PART) == F.col("_sc_p")) & (F.col(_HEAD) > 0), "left")
        change = {n: F.col(n) + F.coalesce(F.col(f"_sc_s{i}"), F.lit(0)) for i, n in enumerate(sums.values())}
        change |= {n: F.when(F.col(_HEAD) == 2, F.col(f"_sc_l{i}")).otherwise(F.col(n)) for i, n in enumerate(lags.values())}
    out = {n: change.get(n, F.col(n)) for n in [*sums.values(), *lags.values()]}
    if position:
        out[position] = out.pop("_sc_n") - 1
    return done.select(*[F.col(f"`{c}`") for c in df.columns], *[c.alias(n) for n, c in out.items()])
