"""Small helpers shared by the operators: staged tables in the cluster's shared
folder, hash keys, and column bookkeeping."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.session import ensure_checkpoint_dir

A_TO_Z_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
A_TO_Z_LOWER = A_TO_Z_UPPER.lower()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared ``spark.checkpoint.dir`` and
    read it back. Cuts the lineage (a lost executor re-reads files instead of
    recomputing), and gives Spark the true size of the table, so that its own
    broadcast threshold is a checked bound."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_pair(c: Column) -> list[Column]:
    """128 bits of hash as two longs (two differently seeded 64-bit hashes)."""
    return [F.xxhash64(c), F.xxhash64(F.lit(1), c)]


def without(df: DataFrame, added: list[str] | tuple) -> list[Column]:
    """The columns of ``df`` except those an operator is about to add: added
    columns win over input columns of the same name."""
    drop = {a.lower() for a in added}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in drop]


def is_held_out(doc_id: Column) -> Column:
    """The fixed evaluation fold: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))
