"""Session helpers: build a session for tests/bench and resolve the shared
checkpoint folder without ever falling back to a machine-local path on a
cluster."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "cartwheel", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("CARTWHEEL_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the session has none (local tests) do we create one under /tmp;
    on a cluster the setting is expected to point at shared storage.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="cartwheel-ckpt-", dir="/tmp")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def stage(df: DataFrame) -> DataFrame:
    """Cut the lineage of a reused intermediate: a reliable checkpoint into the
    shared ``spark.checkpoint.dir`` (survives executor loss; never a
    machine-local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged_parquet(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared ``spark.checkpoint.dir`` and read it
    back: cuts the lineage like ``stage``, keeps column pruning, and tells Spark
    the true size of the table."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread_over(spark: SparkSession) -> int:
    """Partitions for rows that are few bytes but long to compute: several per core,
    given as a number, so adaptive execution doesn't join them by their bytes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def drop_staged(*tables: DataFrame) -> None:
    """Remove tables of ``staged_parquet`` that no later job reads, not even to
    recompute lost partitions: all their readers are staged themselves."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        folder = ensure_checkpoint_dir(df.sparkSession)
        for path in {os.path.dirname(f) for f in df.inputFiles()}:
            if path.split(":", 1)[-1].lstrip("/").startswith(folder.split(":", 1)[-1].lstrip("/")):
                p = sc._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
