"""Structured Streaming form of the daily event counts (E2 / D1 style).

The clickstream table is read as a file stream, mapped to the reference's
event vocabulary, and aggregated per (day window, event), with a watermark if
the caller gives one. Each
micro-batch writes the totals it changed into the shared checkpoint folder
(``foreachBatch``), and the stream keeps its own checkpoint there, so a
restarted job resumes instead of recounting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.sources.tables import EVENT_MAP
from cartwheel.session import ensure_checkpoint_dir


def clickstream_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """The events table as a file stream: a directory of part files, or a
    single file (then the folder is read with the file's name as filter)."""
    path = f"{sf_dir}/events.parquet"
    files = spark.read.parquet(path)
    single = files.select(F.input_file_name()).limit(1).collect()
    is_file = bool(single) and single[0][0].rstrip("/").endswith("/events.parquet")
    s = spark.readStream.schema(files.schema).option("maxFilesPerTrigger", max_files_per_trigger)
    s = s.option("pathGlobFilter", "events.parquet").parquet(sf_dir) if is_file else s.parquet(path)
    ev = s.where(F.col("event_type").isin(list(EVENT_MAP)))
    event = F.when(F.col("event_type") == "view", "view").when(F.col("event_type") == "click", "addtocart") \
        .otherwise("transaction")
    return ev.select(F.col("ts").alias("timestamp"), F.col("user_id").alias("visitorid"), event.alias("event"))


def daily_event_counts(spark: SparkSession, sf_dir: str, out_dir: str | None = None,
                       watermark: str | None = None) -> DataFrame:
    """Run the stream to completion (availableNow) and return the table.

    Days are event-time windows. Without a watermark every row counts, in
    however many micro-batches and whatever order the files come; the state is a
    row per day and event. A live feed passes its own lateness as ``watermark``:
    then state of older days is dropped, and so are their late rows. In update mode a micro-batch delivers the new totals of
    the days it touched; each is written under its batch number (a retried
    batch overwrites its own folder) and the last total of a day is its count."""
    import uuid
    root = ensure_checkpoint_dir(spark).rstrip("/")
    out = out_dir or f"{root}/cartwheel_streams/{uuid.uuid4().hex}"
    events = clickstream_stream(spark, sf_dir).withColumn("ts_ltz", F.col("timestamp").cast("timestamp"))
    if watermark is not None:
        events = events.withWatermark("ts_ltz", watermark)
    agg = events \
        .groupBy(F.window("ts_ltz", "1 day").alias("day"), F.to_date("timestamp").alias("date"), "event") \
        .agg(F.count(F.lit(1)).alias("count"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.select("day.start", "date", "event", "count").withColumn("batch", F.lit(batch_id)) \
            .write.mode("overwrite").parquet(f"{out}/counts/part={batch_id}")
    q = agg.writeStream.outputMode("update").option("checkpointLocation", f"{out}/checkpoint") \
        .foreachBatch(write_batch).trigger(availableNow=True).start()
    q.awaitTermination()
    # outside UTC a calendar date meets two window days
    last = spark.read.parquet(f"{out}/counts").groupBy("start", "date", "event").agg(F.max_by("count", "batch").alias("count"))
    return last.groupBy("date", "event").agg(F.sum("count").alias("count"))
