"""Raw event records built from the driver's test tables.

These builders only reshape table rows into the record format the job reads
-- ``(topic, key, value)`` with a JSON event in ``value`` -- and do none of
the job's work.  Every downstream step parses that JSON like any other input.

``events`` -> one behaviour event per row:

    uid        = user_id
    bizType    = 'order' for purchases, otherwise 'social'
    eventType  = event_type,  targetType = 'user'
    ext        = {eventTime: epoch ms of ts, value, k (from props),
                  targetUid: k, anchorUid: event_id % 7}
    topic      = 'ORDER' for purchases, otherwise 'LIVEROOM'

``orders`` -> one 'order/placed/shop' event per order (uid = o_custkey).
``lineitem`` -> one 'order/shipped/part' event per line (uid = l_suppkey).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ms(col: str):
    """Epoch ms of a TIMESTAMP_NTZ column, read as UTC whatever the session zone."""
    return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {col})")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over the cores.

    Event tables are small as files: a scan has a task for each 128 MB or row group, which leaves most
    cores idle while a few parse all the JSON.  The columns are dealt before the JSON is made of them.
    """
    return df.repartition(2 * max(1, df.sparkSession.sparkContext.defaultParallelism))


def _records(df: DataFrame, topic, key, event) -> DataFrame:
    return spread(df).select(topic.alias("topic"), key.cast("string").alias("key"), F.to_json(event).alias("value"))


def event_records(spark: SparkSession, sf_dir: str, uid=None) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    purchase = F.col("event_type") == "purchase"
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    event = F.struct(
        (F.col("user_id") if uid is None else uid).alias("uid"),
        F.when(purchase, "order").otherwise("social").alias("bizType"),
        F.col("event_type").alias("eventType"),
        F.lit("user").alias("targetType"),
        F.struct(
            _ms("ts").alias("eventTime"), F.col("value").alias("value"), k.alias("k"),
            k.alias("targetUid"), (F.col("event_id") % 7).alias("anchorUid"),
        ).alias("ext"),
    )
    return _records(ev, F.when(purchase, "ORDER").otherwise("LIVEROOM"), F.col("user_id"), event)


def prefixed_event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_records`` with ids ``acct:<user_id>``, and white space for every seventh event."""
    return event_records(spark, sf_dir, F.when(F.col("event_id") % 7 == 0, F.lit(" \t")).otherwise(F.concat(F.lit("acct:"), F.col("user_id").cast("string"))))


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    event = F.struct(
        F.col("o_custkey").alias("uid"), F.lit("order").alias("bizType"), F.lit("placed").alias("eventType"),
        F.lit("shop").alias("targetType"),
        F.struct(_ms("o_orderdate").alias("eventTime"), F.col("o_totalprice").alias("price"),
                 F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
                 F.col("o_orderkey").alias("targetUid")).alias("ext"),
    )
    return _records(o, F.lit("ORDER"), F.col("o_custkey"), event)


def lineitem_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    event = F.struct(
        F.col("l_suppkey").alias("uid"), F.lit("order").alias("bizType"), F.lit("shipped").alias("eventType"),
        F.lit("part").alias("targetType"),
        F.struct(_ms("l_shipdate").alias("eventTime"), F.col("l_quantity").alias("qty"),
                 F.col("l_extendedprice").alias("price"), F.col("l_returnflag").alias("flag"),
                 F.col("l_partkey").alias("targetUid")).alias("ext"),
    )
    return _records(li, F.lit("ORDER"), F.col("l_suppkey"), event)
