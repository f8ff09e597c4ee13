"""Mixing sources to target weights by Pfair scheduling, with built-in functions only.

Every source's rows are put in a fixed pseudo-random order and cut into blocks
of ``block_rows``. With integer shares n_i (weight n_i / D, D their sum) block
k of a source may not start before slot floor(k D / n_i) and must be placed
before slot ceil((k + 1) D / n_i); one block per slot, earliest deadline first
among the released ones. The windows make every prefix of the schedule deviate
from the target by less than one block per source. All lags are zero after D
slots, so the schedule is periodic and a table of D slots (shares only, no
data) places any block. When a source runs out, the remaining shares form the
next phase with a schedule of their own, so no row is dropped or repeated.

The driver sees one row count per named source and plans at most one phase per
source; all row work is distributed: rank within a source = offset of the
row's (source, order range) bucket + row number inside the bucket, so a source
with a third of all rows is spread over its buckets.

Sources without a share form one class ``other`` with the share
``other_share``; a null source belongs to it. Shares must be positive. Rows with
equal ids are ordered by their text; full repeats are kept, in any order
among themselves. A null id sorts by its text. Input columns named like an
added column are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import without

ADDED = ("mix_class", "mix_phase", "mix_slot", "mix_position")
OTHER = "(other)"
ORDER_BITS = 60
ROWS_PER_BUCKET = 4096


def edf_period(shares: list[int]) -> list[int]:
    """Class index of each of the sum(shares) slots of one period."""
    total, taken, out = sum(shares), [0] * len(shares), []
    for slot in range(total):
        ready = [(-(-(k + 1) * total // n), i) for i, (k, n) in enumerate(zip(taken, shares))
                 if k * total // n <= slot and k < n]
        i = min(ready)[1]
        taken[i] += 1
        out.append(i)
    return out


@dataclass
class Run:
    """Blocks ``first .. last`` of one class in one phase."""
    name: str
    phase: int
    first: int
    last: int
    share: int
    period: int
    slots: list[int]
    slot0: int
    row0: int


def plan_runs(rows: dict[str, int], shares: dict[str, int], block_rows: int) -> list[Run]:
    """Phases of the mix for the row counts of the classes."""
    names = sorted(n for n in shares if rows.get(n, 0) > 0)
    left = {n: -(-rows[n] // block_rows) for n in names}
    done = {n: 0 for n in names}
    runs, phase, slot0, row0 = [], 0, 0, 0
    while names:
        n_i = [shares[n] for n in names]
        period, total = edf_period(n_i), sum(n_i)
        where = [[s for s, i in enumerate(period) if i == j] for j in range(len(names))]
        # slot of each class's last block; the phase ends with the earliest of them
        ends = [(left[n] - 1) // n_i[j] * total + where[j][(left[n] - 1) % n_i[j]] for j, n in enumerate(names)]
        length = min(ends) + 1
        placed_rows = 0
        for j, n in enumerate(names):
            blocks = length // total * n_i[j] + sum(s < length % total for s in where[j])
            if blocks:
                runs.append(Run(n, phase, done[n], done[n] + blocks - 1, n_i[j], total, where[j], slot0, row0))
            placed_rows += min(rows[n], (done[n] + blocks) * block_rows) - min(rows[n], done[n] * block_rows)
            done[n] += blocks
            left[n] -= blocks
        slot0, row0, phase = slot0 + length, row0 + placed_rows, phase + 1
        names = [n for n in names if left[n]]
    return runs


def order_key(id_: Column) -> Column:
    """60 pseudo-random bits of an id, the order inside a source."""
    return F.conv(F.substring(F.md5(id_.cast("string")), 1, ORDER_BITS // 4), 16, 10).cast("long")


RUN_SCHEMA = T.StructType([
    T.StructField("_mx_class", T.StringType()), T.StructField("_mx_phase", T.IntegerType()),
    T.StructField("_mx_first", T.LongType()), T.StructField("_mx_last", T.LongType()),
    T.StructField("_mx_share", T.LongType()), T.StructField("_mx_period", T.LongType()),
    T.StructField("_mx_slots", T.ArrayType(T.LongType())), T.StructField("_mx_slot0", T.LongType()),
    T.StructField("_mx_row0", T.LongType())])


def mix_sources(docs: DataFrame, shares: dict[str, int], other_share: int = 1, block_rows: int = 16,
                source_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus ``mix_class``, ``mix_phase``,
    ``mix_slot`` (the block's slot) and ``mix_position`` (0-based place in the mix)."""
    if any(n <= 0 for n in [*shares.values(), other_share]):
        raise ValueError("shares must be positive")
    spark = docs.sparkSession
    shares = {**shares, OTHER: other_share}
    source = F.col(source_col).cast("string")
    cls = F.when(source.isin(list(shares)), source).otherwise(F.lit(OTHER))
    counts = {r[0]: r[1] for r in docs.groupBy(cls.alias("c")).count().collect()}  # a row per share
    runs = plan_runs(counts, shares, block_rows)
    plan = spark.createDataFrame([(r.name, r.phase, r.first, r.last, r.share, r.period, r.slots, r.slot0, r.row0)
                                  for r in runs], RUN_SCHEMA)

    buckets = max(1, -(-sum(counts.values()) // ROWS_PER_BUCKET))
    key = order_key(F.coalesce(F.col(id_col).cast("string"), F.col(text_col).cast("string"), F.lit("")))
    bucket = F.shiftright(F.shiftright(key, ORDER_BITS // 2) * F.lit(buckets), ORDER_BITS // 2)
    keyed = docs.select(*without(docs, ADDED), cls.alias("_mx_class"), key.alias("_mx_key")) \
        .withColumn("_mx_bucket", F.shiftright(F.shiftright(F.col("_mx_key"), ORDER_BITS // 2) * F.lit(buckets),
                                               ORDER_BITS // 2))
    sizes = docs.select(cls.alias("_mx_class"), bucket.alias("_mx_bucket")) \
        .groupBy("_mx_class", "_mx_bucket").agg(F.count(F.lit(1)).alias("_mx_n"))
    before = Window.partitionBy("_mx_class").orderBy("_mx_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_mx_class", "_mx_bucket",
                           F.coalesce(F.sum("_mx_n").over(before), F.lit(0)).alias("_mx_before"))

    inside = Window.partitionBy("_mx_class", "_mx_bucket").orderBy("_mx_key", F.col(id_col), F.col(text_col))
    ranked = keyed.withColumn("_mx_no", F.row_number().over(inside)) \
        .join(offsets, ["_mx_class", "_mx_bucket"]) \
        .withColumn("_mx_rank", F.col("_mx_before") + F.col("_mx_no") - 1) \
        .withColumn("_mx_block", F.floor(F.col("_mx_rank") / F.lit(block_rows)).cast("long"))
    # at most one row per pair of shares, each with at most sum(shares) slots: a bound set by the parameters
    placed = ranked.join(F.broadcast(plan), ["_mx_class"]).where(
        (F.col("_mx_block") >= F.col("_mx_first")) & (F.col("_mx_block") <= F.col("_mx_last")))
    k = F.col("_mx_block") - F.col("_mx_first")
    slot = F.floor(k / F.col("_mx_share")).cast("long") * F.col("_mx_period") \
        + F.get(F.col("_mx_slots"), (k % F.col("_mx_share")).cast("int"))
    return placed.select(
        *without(docs, ADDED), F.col("_mx_class").alias("mix_class"), F.col("_mx_phase").alias("mix_phase"),
        (F.col("_mx_slot0") + slot).alias("mix_slot"),
        (F.col("_mx_row0") + slot * F.lit(block_rows) + F.col("_mx_rank") % F.lit(block_rows)).alias("mix_position"))
