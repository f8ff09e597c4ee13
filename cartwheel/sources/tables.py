"""Scans of the given parquet tables and the two adapters that present them in
the reference's shape (clickstream + property changelog; order lines).

Adapter A (``events``):
  view -> view, click -> addtocart, purchase -> transaction;
  timestamp = ts, visitorid = user_id, itemid = props.$.k,
  transactionid = user_id * 1000 + dayofyear(ts) for purchases.
  signup rows -> property 790 (price) with value 'n' || value ('n0.0' when
  event_id % 17 = 0); error rows -> categoryid = event_id % 10 (even ids) or
  available = (event_id % 3 = 0) (odd ids); ingest_seq = event_id.

Adapter B (``orders`` join ``lineitem``):
  visitorid = o_custkey, transactionid = o_orderkey, timestamp = o_orderdate,
  itemid = l_partkey, price = l_extendedprice, event = 'transaction'.

All adapters are projections/filters, so Catalyst pushes the filters and the
column pruning into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the event vocabulary (source name -> reference name).
EVENT_MAP = {"view": "view", "click": "addtocart", "purchase": "transaction"}
PRICE_PROPERTY = "790"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _item_key() -> F.Column:
    return F.get_json_object("props", "$.k").cast("long")


def clickstream_events(spark: SparkSession, sf_dir: str, with_seq: bool = True) -> DataFrame:
    """Raw clickstream: timestamp, visitorid, event, itemid, transactionid[, event_id]."""
    ev = read_table(spark, sf_dir, "events").where(F.col("event_type").isin(list(EVENT_MAP)))
    event = F.when(F.col("event_type") == "view", "view") \
        .when(F.col("event_type") == "click", "addtocart") \
        .otherwise("transaction")
    cols = [
        F.col("ts").alias("timestamp"),
        F.col("user_id").alias("visitorid"),
        event.alias("event"),
        _item_key().alias("itemid"),
        F.when(F.col("event_type") == "purchase",
               F.col("user_id") * 1000 + F.dayofyear("ts")).cast("long").alias("transactionid"),
    ]
    if with_seq:
        cols.append(F.col("event_id"))
    return ev.select(*cols)


def item_property_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity-attribute-value changelog: timestamp, itemid, property, value, ingest_seq."""
    ev = read_table(spark, sf_dir, "events").where(F.col("event_type").isin("signup", "error"))
    eid = F.col("event_id")
    prop = F.when(F.col("event_type") == "signup", F.lit(PRICE_PROPERTY)) \
        .when(eid % 2 == 0, F.lit("categoryid")).otherwise(F.lit("available"))
    value = F.when(F.col("event_type") == "signup",
                   F.when(eid % 17 == 0, F.lit("n0.0"))
                   .otherwise(F.concat(F.lit("n"), F.col("value").cast("string")))) \
        .when(eid % 2 == 0, (eid % 10).cast("string")) \
        .otherwise((eid % 3 == 0).cast("int").cast("string"))
    return ev.select(
        F.col("ts").alias("timestamp"), _item_key().alias("itemid"),
        prop.alias("property"), value.alias("value"), eid.alias("ingest_seq"))


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction lines: timestamp, visitorid, event, itemid, transactionid, price."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_custkey").alias("visitorid"),
        F.lit("transaction").alias("event"),
        F.col("l_partkey").alias("itemid"),
        F.col("o_orderkey").alias("transactionid"),
        F.col("l_extendedprice").alias("price"),
    )


def all_events_end(events: DataFrame, ts: str = "timestamp") -> DataFrame:
    """One-row frame with the latest event time (data_end / obs anchor)."""
    return events.agg(F.max(ts).alias("data_end"))
