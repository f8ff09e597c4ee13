"""Registered source / sink queries (S1, S3, S5-S7, P14, T6) and the
streaming job. Files are written under the session's shared checkpoint
folder, one sub-folder per input folder."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from cartwheel.plans import frames as fr
from cartwheel.plans.registry import register
from cartwheel.plans.sql_adapters import with_ctes
from cartwheel.session import ensure_checkpoint_dir
from cartwheel.sources import files
from cartwheel.streaming import daily_events


def _io_dir(spark, d: str, name: str) -> str:
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/cartwheel_io/{hashlib.md5(d.encode()).hexdigest()[:10]}/{name}"


@register("s1_events_csv_epoch_ms", with_ctes("ev") + """
SELECT date_trunc('millisecond', "timestamp") AS "timestamp", visitorid, event, itemid, transactionid FROM ev""",
          ids="S1,S5")
def q_s1csv(spark, d):
    path = _io_dir(spark, d, "events_csv")
    raw = fr.ev(spark, d).select(files.to_epoch_ms("timestamp").alias("timestamp"), "visitorid", "event", "itemid",
                                 "transactionid")
    files.write_table(raw, path, fmt="csv")
    return files.load_events_csv(spark, path)


@register("s2_s4_property_csv_parts", with_ctes("props") + """
SELECT itemid, "timestamp",
       max_by(value, [ingest_seq % 2, ingest_seq]) FILTER (WHERE property = 'available') AS available,
       max_by(value, [ingest_seq % 2, ingest_seq]) FILTER (WHERE property = 'categoryid') AS categoryid,
       TRY_CAST(regexp_replace(max_by(value, [ingest_seq % 2, ingest_seq]) FILTER (WHERE property = '790'), '^n', '') AS DOUBLE) AS price
FROM (SELECT * REPLACE (date_trunc('millisecond', "timestamp") AS "timestamp") FROM props)
WHERE property IN ('790', 'categoryid', 'available') AND value IS NOT NULL
GROUP BY itemid, "timestamp\"""",
          doubles=["price"], ids="S2,S4,U1,F2")
def q_s2csv(spark, d):
    from cartwheel.operators import features as fe
    log = fr.props(spark, d)
    paths = []
    for i, part in enumerate([log.where(F.col("ingest_seq") % 2 == 0), log.where(F.col("ingest_seq") % 2 == 1)]):
        path = _io_dir(spark, d, f"item_properties_part{i + 1}")
        raw = part.select(files.to_epoch_ms("timestamp").alias("timestamp"), "itemid", "property", "value")
        files.write_table(raw, path, fmt="csv")
        paths.append(path)
    return fe.get_small_props(files.load_item_props_csv(spark, paths))


@register("s3_typed_csv_reload", with_ctes("feats") + "SELECT * FROM feats",
          doubles=["prop_addtocart", "prop_tx", "events_per_active_day", "view_price", "addtocart_price",
                   "tx_price", "avg_inter_event_days"], ids="S3,S5,P14")
def q_s3(spark, d):
    f = fr.feats(spark, d)
    path = _io_dir(spark, d, "user_features_csv")
    files.write_table(f, path, fmt="csv")
    return files.load_typed(spark, path, fmt="csv", schema=f.schema)


@register("s5_s7_parquet_sink_read_back", with_ctes("ewp") + "SELECT * FROM ewp", doubles=["price", "mean_price"],
          ids="S5,S6,S7")
def q_s5(spark, d):
    path = _io_dir(spark, d, "events_with_properties")
    files.write_table(fr.ewp(spark, d), path)
    return files.read_back(spark, path)


@register("p14_coerce_timestamps", with_ctes("ev") + """
SELECT event_id, TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'not a date' ELSE CAST("timestamp" AS VARCHAR) END AS TIMESTAMP) AS parsed
FROM ev""", ids="P14")
def q_p14(spark, d):
    e = fr.ev(spark, d)
    s = F.when(F.col("event_id") % 7 == 0, F.lit("not a date")).otherwise(F.col("timestamp").cast("string"))
    return e.select("event_id", files.coerce_timestamp(s).alias("parsed"))


@register("t6_point_lookup", with_ctes("ewp") + """
SELECT * FROM ewp WHERE visitorid = (SELECT min(visitorid) FROM ewp)""", doubles=["price", "mean_price"], ids="T6,P8")
def q_t6(spark, d):
    e = fr.ewp(spark, d)
    first = e.agg(F.min("visitorid").alias("_v"))
    return e.join(F.broadcast(first), e.visitorid == first._v).drop("_v")


@register("t6_head", ids="T6")
def q_t6h(spark, d):
    return fr.ewp(spark, d).orderBy("timestamp", "event_id").limit(5)


@register("e2_streaming_daily_event_counts", with_ctes("ev") + """
SELECT CAST("timestamp" AS DATE) AS "date", event, count(*) AS count FROM ev GROUP BY 1, 2""",
          ids="E2,streaming")
def q_stream(spark, d):
    return daily_events.daily_event_counts(spark, d)
