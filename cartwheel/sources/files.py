"""File scans and sinks (CSV as in the reference, Parquet by default)."""

from __future__ import annotations

import json
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS_CSV_SCHEMA = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("visitorid", T.LongType()),
    T.StructField("event", T.StringType()),
    T.StructField("itemid", T.LongType()),
    T.StructField("transactionid", T.LongType()),
])

ITEM_PROPS_CSV_SCHEMA = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("itemid", T.LongType()),
    T.StructField("property", T.StringType()),
    T.StructField("value", T.StringType()),
])


def _epoch_ntz() -> F.Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def from_epoch_ms(c) -> F.Column:
    """Epoch milliseconds -> naive (UTC wall-clock) timestamp, independent of
    the session time zone (pandas ``to_datetime(unit='ms')``)."""
    return F.timestamp_add("MILLISECOND", F.col(c) if isinstance(c, str) else c, _epoch_ntz())


def to_epoch_ms(c) -> F.Column:
    return F.timestamp_diff("MILLISECOND", _epoch_ntz(), F.col(c) if isinstance(c, str) else c)


def load_events_csv(spark: SparkSession, path: str) -> DataFrame:
    """Event CSV with epoch-millisecond timestamps."""
    df = spark.read.schema(EVENTS_CSV_SCHEMA).option("header", True).csv(path)
    return df.withColumn("timestamp", from_epoch_ms("timestamp"))


def load_item_props_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S2 + S4: property CSV part(s) with an ingest sequence (part, file name,
    place in the file) that keeps file order however Spark packs the files into
    tasks, so 'last value' means the same as in the concatenated frame."""
    paths = [path] if isinstance(path, str) else list(path)
    parts = []
    for i, p in enumerate(paths):
        d = spark.read.schema(ITEM_PROPS_CSV_SCHEMA).option("header", True).csv(p)
        d = d.withColumn("timestamp", from_epoch_ms("timestamp")) \
             .withColumn("ingest_seq", F.struct(
                 F.lit(i).alias("part"), F.col("_metadata.file_path").alias("file"),
                 F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")))
        parts.append(d)
    return concat_parts(parts)


def concat_parts(parts: list[DataFrame]) -> DataFrame:
    """Union all by name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


TYPED_TS_COLUMNS = ("timestamp", "first_event", "last_event")


def coerce_timestamp(c) -> F.Column:
    """``to_datetime(errors='coerce')`` - unparsable -> NULL, wall clock kept."""
    return F.try_to_timestamp(F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def load_typed(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """S3: re-load a stage output. CSV columns are read as text and cast to
    ``schema`` (when given); the known timestamp columns are parsed with
    coercion."""
    if fmt == "csv":
        df = spark.read.option("header", True).csv(path)
        if schema is not None:
            types = {f.name: f.dataType for f in schema.fields}
            cols = []
            for c in df.columns:
                t = types.get(c)
                if t is None:
                    cols.append(F.col(c))
                elif t.typeName() in ("timestamp_ntz", "timestamp"):
                    cols.append(coerce_timestamp(c).alias(c))
                else:
                    cols.append(F.col(c).try_cast(t).alias(c))
            df = df.select(*cols)
    else:
        df = spark.read.parquet(path)
    for c in TYPED_TS_COLUMNS:
        if c in df.columns and dict(df.dtypes)[c] == "string":
            df = df.withColumn(c, coerce_timestamp(c))
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Table sink."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    else:
        w.parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS"))


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Number and hash of the files (path, size, change time) below ``paths``,
    summed by Spark; the files are listed, not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths) \
        .select("path", "length", "modificationTime")
    n, total = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    return f"{n}:{total or 0}"


def _remove(spark: SparkSession, path: str) -> None:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def materialize(spark: SparkSession, path: str, build: Callable[[], DataFrame], fmt: str = "parquet",
                sources: list[str] | None = None, params: dict | None = None) -> DataFrame:
    """Read the stage if it was written completely, else compute, write, re-read.

    With ``sources`` (files or folders the stage is computed from) the stage has a
    manifest of them and of ``params`` beside it (``<path>.manifest``) and is computed
    again when either changed. The old manifest goes before the table is overwritten
    and the new one comes after it, so an interrupted run leaves none. Without
    ``sources`` a complete table is taken as it is. The written table also cuts the
    lineage (survives executor loss)."""
    if sources is None:
        if not _exists(spark, path):
            write_table(build(), path, fmt=fmt)
        return load_typed(spark, path, fmt=fmt)
    kept = f"{path.rstrip('/')}.manifest"
    wanted = json.dumps({"sources": fingerprint(spark, sources), "params": params or {}, "format": fmt},
                        sort_keys=True, default=str)
    if not (_exists(spark, path) and _exists(spark, kept) and spark.read.text(kept).first() == (wanted,)):
        _remove(spark, kept)
        write_table(build(), path, fmt=fmt)
        spark.createDataFrame([(wanted,)], "value string").coalesce(1).write.text(kept)
    return load_typed(spark, path, fmt=fmt)


def read_back(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S7."""
    return load_typed(spark, path, fmt=fmt)
