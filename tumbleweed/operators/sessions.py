"""Session partials: every kind over gap-separated sessions, by an associative interval merge.

A session is a run of a key's events in which each comes less than ``gap`` after
the one before.  No task sorts a key's whole history:

1. *slots* -- time is cut into slots of the gap's length.  Events of one slot are
   always in one session, so a slot is an interval (first, last event) with the
   partials of its kind: one hash aggregate, combined map-side.
2. *pieces* -- ``SLOTS`` slots make a bucket.  Inside (key, bucket), slots less than
   a gap apart merge into pieces; a busy key is spread over its buckets.
3. *edges* -- only a bucket's first and last piece can go on in another bucket.
   They alone are stitched along the key: two rows for a bucket of ``SLOTS`` slots.
   All other pieces are sessions as they are.

LIST, SET and LATEST entries find their session through their slot, an equi-join
on (key, slot); ``row_number`` then keeps the newest ``capacity``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tumbleweed.operators.panes import ITEM_KINDS, combine_aggs, contributing, partial_aggs, partial_keys
from tumbleweed.plans.compile import unbroadcast
from tumbleweed.session import compiled_code_only, scratch_path

KEY = ["id", "id_type", "feature", "kind", "sub_key"]
#: Slots of a gap's length in a bucket.
SLOTS = 1024


def session_slots(routed: DataFrame, gap_ms: int) -> DataFrame:
    """Partials of each (key, slot, entry), with the slot's first and last event time."""
    rows = contributing(routed).withColumn("slot", F.floor(F.col("event_ms") / F.lit(gap_ms)))
    return rows.groupBy(*KEY, "slot", *partial_keys(rows)).agg(
        F.min("event_ms").alias("first_ms"), F.max("event_ms").alias("last_ms"), *partial_aggs())


_PARTIALS = ["cnt", "_sum_l", "_max_l", "_min_l", "_sum_d", "_max_d", "_min_d"]


def _merged() -> list:
    """Intervals into one: the associative combine of sessions."""
    return [F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"), *combine_aggs()[:len(_PARTIALS)]]


def _merge(grouped) -> DataFrame:
    return grouped.agg(*_merged())


def _starts_anew(window, gap_ms: int):
    before = F.lag("last_ms").over(window)
    return F.when(before.isNull() | (F.col("first_ms") - before >= F.lit(gap_ms)), 1).otherwise(0)


def build_session_panes(routed: DataFrame, gap_ms: int, slots_in_bucket: int = SLOTS) -> DataFrame:
    """Sessions of every (entity, feature): ``session_start_ms, session_end_ms`` (last event plus the gap), ``cnt``,
    ``num_long``, ``num_double`` and ``items`` (newest first; LATEST: one).

    ``cnt`` counts the contributing events.  Sums that leave their type are NULL.
    The slots are written once to the shared folder: they feed the chain and the entries.
    So are the pieces, with the slots they are made of.
    """
    spark = routed.sparkSession
    path = scratch_path(spark, "session-slots")
    found = session_slots(routed, gap_ms)
    with compiled_code_only(spark):
        found.write.parquet(path)
    partials = spark.read.schema(found.schema).parquet(path)

    in_bucket = [*KEY, "bucket"]
    chain = Window.partitionBy(*in_bucket).orderBy("slot")
    is_item = F.col("kind").isin(*ITEM_KINDS)
    aggregates = ["first_ms", "last_ms", *_PARTIALS]
    # other kinds have one row for a slot already
    slots = (partials.where(~is_item).select(*KEY, "slot", *aggregates)
             .unionByName(_merge(partials.where(is_item).groupBy(*KEY, "slot")).select(*KEY, "slot", *aggregates)))
    slots = (slots.withColumn("bucket", F.floor(F.col("slot") / F.lit(slots_in_bucket)))
             .withColumn("fresh", _starts_anew(chain, gap_ms)).withColumn("piece", F.sum("fresh").over(chain)))
    merged = slots.groupBy(*in_bucket, "piece").agg(*_merged(), F.collect_list(F.when(is_item, F.col("slot"))).alias("slots"))
    merged = merged.select(*in_bucket, "piece", "slots", *aggregates).withColumn("pieces", F.max("piece").over(Window.partitionBy(*in_bucket)))
    # read four times below: written once, or each reading would shuffle the slots again
    path = scratch_path(spark, "session-pieces")
    merged.write.parquet(path)
    pieces = spark.read.schema(merged.schema).parquet(path)
    at_edge = (F.col("piece") == 1) | (F.col("piece") == F.col("pieces"))

    along = Window.partitionBy(*KEY).orderBy("bucket", "piece")
    edges = pieces.where(at_edge).withColumn("fresh", _starts_anew(along, gap_ms))
    edges = edges.withColumn("start", F.last(F.when(F.col("fresh") == 1, F.col("first_ms")), ignorenulls=True).over(along))
    stitched = _merge(edges.groupBy(*KEY, "start")).drop("start")
    columns = [*KEY, *aggregates]
    sessions = pieces.where(~at_edge).select(*columns).unionByName(stitched.select(*columns)).select(
        *KEY, F.col("first_ms").alias("session_start_ms"), (F.col("last_ms") + F.lit(gap_ms)).alias("session_end_ms"), "cnt",
        F.coalesce("_sum_l", "_max_l", "_min_l").alias("num_long"), F.coalesce("_sum_d", "_max_d", "_min_d").alias("num_double"))

    # each piece names its slots, so the start of its session reaches them without a join
    of_slot = (pieces.where(is_item & ~at_edge).select(*KEY, "slots", F.col("first_ms").alias("session_start_ms"))
               .unionByName(edges.where(is_item).select(*KEY, "slots", F.col("start").alias("session_start_ms"))))
    of_slot = of_slot.select(*KEY, F.explode("slots").alias("slot"), "session_start_ms")
    entries = partials.where(is_item).select(*KEY, "slot", "_v", "_t", "item_ms", "capacity").join(unbroadcast(of_slot), [*KEY, "slot"])
    of_session = [*KEY, "session_start_ms"]
    folded = entries.groupBy(*of_session, "_v", "_t").agg(F.max("item_ms").alias("item_ms"), F.max("capacity").alias("capacity"))
    newest = Window.partitionBy(*of_session).orderBy(F.col("item_ms").desc(), F.col("_v").desc())
    limit = F.when(F.col("kind") == "latest", F.lit(1)).otherwise(F.col("capacity"))
    items = (folded.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= limit).groupBy(*of_session)
             .agg(F.sort_array(F.collect_list(F.struct(F.col("item_ms").alias("ts"), F.col("_v").alias("value"))), asc=False).alias("items")))
    # only sessions of item kinds are shuffled for their items
    with_items = sessions.where(is_item).join(unbroadcast(items), of_session, "left")
    return sessions.where(~is_item).withColumn("items", F.lit(None).cast(items.schema["items"].dataType)).unionByName(with_items)
