"""Registered queries: each runs the library over the test tables.

Every query reads the driver's tables (``events``, ``orders``, ``lineitem``)
through the stand-in record builders and runs the library's own operators.
Double-valued results are reported rounded to cents so that an exact decimal
oracle can be compared; the features themselves are computed in double.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tumbleweed.operators.fanout import fan_out
from tumbleweed.operators.panes import retain_panes
from tumbleweed.operators.route import ROUTE_KEYS
from tumbleweed.operators.sessions import build_session_panes
from tumbleweed.operators.sinks import cell_snapshot, feature_messages, message_batches, output_counts, serving_cells
from tumbleweed.operators.snapshot import CellSnapshot
from tumbleweed.plans.catalog import EDGE_SPECS, EVENT_SPECS, LINEITEM_SPECS, ORDER_SPECS
from tumbleweed.plans.compile import spec_broadcast
from tumbleweed.plans.job import FeatureJob
from tumbleweed.sources.events import parse_events
from tumbleweed.session import scratch_path
from tumbleweed.sources.specs import read_specs, specs_from_json
from tumbleweed.sources.standin import event_records, lineitem_records, order_records, prefixed_event_records

MINUTE, HOUR, SECOND = 60_000, 3_600_000, 1_000


# The test tables are written in UTC: whole-day windows use UTC days.
DAY_ZONE = "UTC"


def _job(spark: SparkSession, ids=None, pane_ms: int = MINUTE, specs=EVENT_SPECS) -> FeatureJob:
    chosen = [s for s in specs if ids is None or s["id"] in ids]
    return FeatureJob(specs_from_json(spark, chosen), pane_ms=pane_ms, tz=DAY_ZONE)


def _typed(features: DataFrame) -> DataFrame:
    return features.select(
        "id", "id_type", "feature_name", "ts", "value_long",
        F.round("value_double", 2).alias("value_double"),
        F.when(~F.col("value_type").isin("long", "double"), F.col("value_text")).alias("value_text"),
    )


def _windowed(spark, sf, ids, pane_ms=MINUTE, specs=EVENT_SPECS, records=event_records, windows=None):
    job = _job(spark, ids, pane_ms, specs)
    return job.windowed_features(records(spark, sf), windows=windows)


# --------------------------------------------------------------------------- sources / routing
def parse_events_q(spark: SparkSession, sf: str) -> DataFrame:
    ev = parse_events(event_records(spark, sf))
    ext = F.col("ext")
    return ev.select("topic", "uid", "biz_type", "event_type", "target_type", "event_ms",
                     ext["value"].alias("ext_value"), ext["k"].alias("ext_k"),
                     ext["anchorUid"].alias("ext_anchor"))


def dim_fanout(spark: SparkSession, sf: str) -> DataFrame:
    fanned = fan_out(parse_events(event_records(spark, sf)))
    return fanned.select("topic", "id_type", "id", "event_ms", "event_type")


def route_match(spark: SparkSession, sf: str) -> DataFrame:
    job = _job(spark)
    return job.routed(event_records(spark, sf)).select("spec_id", "feature", "id", "id_type", "event_ms")


def atom_features_q(spark: SparkSession, sf: str) -> DataFrame:
    job = _job(spark, {14})
    return job.atom_features(event_records(spark, sf)).select(
        "id", "id_type", "feature_name", "ts", F.col("value_text").alias("value"))


def spec_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Per spec of a spec table: rejection reason (if any) and the number of events routed to it."""
    path = scratch_path(spark, "specs")
    spark.createDataFrame([(json.dumps(s),) for s in EVENT_SPECS], "value string").write.text(path)
    specs = read_specs(spark, path)
    job = FeatureJob(specs, tz=DAY_ZONE)
    cs = job.compiled
    routes = cs.routes.select("spec_id", *ROUTE_KEYS).distinct()
    fanned = job.fanned(event_records(spark, sf))
    counts = fanned.join(spec_broadcast(routes, len(cs.rows["routes"])), ROUTE_KEYS).groupBy("spec_id").agg(
        F.count(F.lit(1)).alias("routed_events"))
    named = specs.select(F.col("id").alias("spec_id"), F.col("featureNamePrefix").alias("feature"))
    return (named.join(cs.validation.select("spec_id", "error"), "spec_id", "left")
            .join(counts, "spec_id", "left")
            .select("spec_id", "feature", "error",
                    F.coalesce("routed_events", F.lit(0)).cast("bigint").alias("routed_events")))


# --------------------------------------------------------------------------- panes
def pane_count(spark: SparkSession, sf: str) -> DataFrame:
    panes = _job(spark, {1}).panes(event_records(spark, sf))
    return panes.select("id", "id_type", "feature", "pane_end_ms", "cnt")


def pane_count_grouped(spark: SparkSession, sf: str) -> DataFrame:
    panes = _job(spark, {2}).panes(event_records(spark, sf))
    return panes.select("id", "id_type", "feature", "sub_key", "pane_end_ms", "cnt")


def session_partials(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions of every kind: COUNT (grouped too), SUM, MAX, MIN, LIST, SET and LATEST."""
    job = _job(spark, {1, 2, 4, 7, 8, 9, 11, 13})
    panes = build_session_panes(job.routed(event_records(spark, sf)), gap_ms=10 * MINUTE)
    return panes.select("id", "id_type", "feature", "sub_key", "session_start_ms", "session_end_ms", "cnt", "num_long",
                        F.to_json("items").alias("items"))


def retention_panes(spark: SparkSession, sf: str) -> DataFrame:
    job = _job(spark, {1, 2, 4, 9})
    records = event_records(spark, sf)
    # as of the newest event: a scalar aggregate, the clock of this backfill
    as_of = job.events(records).agg(F.max("event_ms")).first()[0]
    kept = retain_panes(job.panes(records), job.compiled, as_of, MINUTE)
    return kept.select("id", "id_type", "feature", "sub_key", "pane_end_ms")


# --------------------------------------------------------------------------- roll-ups
def _features_q(ids, names=None, pane_ms=MINUTE, specs=EVENT_SPECS, records=event_records):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        out = _windowed(spark, sf, ids, pane_ms, specs, records, windows=names)
        return _typed(out).select("id", "feature_name", "ts", "value_long", "value_double", "value_text")
    return run


rel_count = _features_q({1}, ["10m", "3h", "24h"])
rel_count_grouped = _features_q({2}, ["10m", "3h"])
rel_sum_long = _features_q({4}, ["10m", "3h", "24h"])
rel_sum_double = _features_q({3})
rel_max = _features_q({5, 7})
rel_min = _features_q({6, 8})
recent_list = _features_q({9})
recent_list_ts = _features_q({10})
recent_set = _features_q({11})
recent_set_ts = _features_q({12})
latest_value = _features_q({13})
whole_today = _features_q({1, 2, 4}, ["today"])
whole_yesterday = _features_q({1, 2, 4}, ["yesterday"])
hourly_cadence = _features_q({17}, pane_ms=HOUR)
second_cadence = _features_q({18}, pane_ms=SECOND)
target_dims = _features_q({15, 16})
recent_set_custom_time = _features_q({301}, specs=EDGE_SPECS)
rel_sum_huge = _features_q({302}, specs=EDGE_SPECS)
prefixed_ids = _features_q({1}, ["10m", "3h", "24h"], records=prefixed_event_records)
orders_spend_windows = _features_q(None, specs=ORDER_SPECS, records=order_records)
lineitem_part_demand = _features_q(None, specs=LINEITEM_SPECS, records=lineitem_records)


def all_features(spark: SparkSession, sf: str) -> DataFrame:
    """Every windowed feature of every cadence and every atom feature, one schema."""
    job = _job(spark)
    records = event_records(spark, sf)
    return _typed(job.features(records))


# --------------------------------------------------------------------------- sinks
def _cells(spark: SparkSession, sf: str) -> DataFrame:
    job = _job(spark, {1, 4, 11, 13, 14})
    # compute only what a cell sink persists
    persisted = [r.feature_name for r in job.compiled.rows["sink_fields"]]
    job.compiled = job.compiled.restrict_features(persisted)
    return serving_cells(job.features(event_records(spark, sf)), job.compiled)


def serving_cells_q(spark: SparkSession, sf: str) -> DataFrame:
    return _cells(spark, sf).select("table", "row_key", "column", "ts", "value", "ttl_ms")


def cell_snapshot_q(spark: SparkSession, sf: str) -> DataFrame:
    from tumbleweed.functions.scalars import timestamped_value

    snap = cell_snapshot(_cells(spark, sf))
    return snap.select("table", "row_key", "column", "ts", "value", "expires_at_ms",
                       timestamped_value(F.col("ts"), F.col("value")).alias("cache_text"))


def cell_snapshot_live(spark: SparkSession, sf: str) -> DataFrame:
    """The newest version of each cell that has not expired when the newest event happens (O3)."""
    from tumbleweed.functions.scalars import timestamped_value

    # a scalar aggregate: the clock of this backfill
    as_of = parse_events(event_records(spark, sf)).agg(F.max("event_ms")).first()[0]
    snap = cell_snapshot(_cells(spark, sf), as_of)
    return snap.select("table", "row_key", "column", "ts", "value", "expires_at_ms",
                       timestamped_value(F.col("ts"), F.col("value")).alias("cache_text"))


def snapshot_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The snapshot after four deltas, the last of them applied twice, each merged into the bucketed base (O2)."""
    from tumbleweed.functions.scalars import timestamped_value

    cells = _cells(spark, sf)
    path = scratch_path(spark, "cells")
    cells.write.parquet(path)
    cells = spark.read.schema(cells.schema).parquet(path)
    snapshot = CellSnapshot(spark, scratch_path(spark, "snapshot"))
    cuts = cells.agg(F.percentile_approx("ts", [0.25, 0.5, 0.75])).first()[0] or [0, 0, 0]
    part = sum((F.when(F.col("ts") > F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
    for number in (0, 1, 2, 3, 3):
        snapshot.apply(cells.where(part == number), number)
    return snapshot.read().select("table", "row_key", "column", "ts", "value", "expires_at_ms",
                                  timestamped_value(F.col("ts"), F.col("value")).alias("cache_text"))


def feature_messages_q(spark: SparkSession, sf: str) -> DataFrame:
    msgs = feature_messages(_cells(spark, sf))
    return msgs.select("id", "id_type", "biz_type", "ts", F.size("kv").alias("n_columns"),
                       F.explode("kv").alias("column", "value"))


def message_batches_q(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of batches of two rows, or a second, per entity."""
    msgs = message_batches(_cells(spark, sf), max_rows=2)
    return msgs.select("id", "id_type", "biz_type", "ts", "batch", F.size("kv").alias("n_columns"), F.explode("kv").alias("column", "value"))


def output_counts_q(spark: SparkSession, sf: str) -> DataFrame:
    return output_counts(_cells(spark, sf))


# --------------------------------------------------------------------------- streaming
def stream_panes(spark: SparkSession, sf: str) -> DataFrame:
    """Panes by Spark's stateful aggregation under a watermark."""
    from tumbleweed.streaming.job import stateful_panes_from_table

    return stateful_panes_from_table(spark, sf, _job(spark, {1, 2, 4})).select(
        "id", "id_type", "feature", "sub_key", "pane_end_ms", "cnt", "num_long")


def stream_features(spark: SparkSession, sf: str) -> DataFrame:
    from tumbleweed.streaming.job import run_pane_stream_from_table

    features = run_pane_stream_from_table(spark, sf, _job(spark, {1, 2, 4}))[1]
    return _typed(features).select("id", "feature_name", "ts", "value_long")


def stream_recent(spark: SparkSession, sf: str) -> DataFrame:
    """LIST, SET and LATEST through the stream (item partials in the pane table, top-K per closed pane)."""
    from tumbleweed.streaming.job import run_pane_stream_from_table

    features = run_pane_stream_from_table(spark, sf, _job(spark, {9, 11, 13}))[1]
    return _typed(features).select("id", "feature_name", "ts", "value_text")


def stream_all_features(spark: SparkSession, sf: str) -> DataFrame:
    """Every kind of feature at every cadence, and the atoms, through the stream."""
    from tumbleweed.streaming.job import run_pane_stream_from_table

    return _typed(run_pane_stream_from_table(spark, sf, _job(spark))[1])


def stream_retention(spark: SparkSession, sf: str) -> DataFrame:
    """The pane table after enough batches to be trimmed and compacted: what is inside its retention."""
    from tumbleweed.streaming.job import catch_up_from_table
    from tumbleweed.streaming.pane_table import PaneTable

    job = _job(spark, {1, 2, 4, 9})
    table = PaneTable(spark, catch_up_from_table(spark, sf, job, chunks=10).panes)
    version = table.latest()
    kept = retain_panes(table.panes(version.panes), job.compiled, version.watermark, MINUTE)
    return kept.select("id", "id_type", "feature", "sub_key", "pane_end_ms", "cnt", "num_long")


def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Features where one event in seven comes a quarter late: counted, merged, and what looks back on them corrected."""
    from tumbleweed.streaming.job import catch_up_from_table, read_features
    from tumbleweed.streaming.pane_table import PaneTable

    late = F.get_json_object("value", "$.ext.anchorUid") == "0"
    paths = catch_up_from_table(spark, sf, _job(spark, {1, 4}), lateness="3650d", late=late)
    version = PaneTable(spark, paths.panes).latest()
    return _typed(read_features(spark, paths)).select(
        "id", "feature_name", "ts", "value_long", F.lit(version.late).cast("bigint").alias("late_events"),
        F.lit(version.applied).cast("bigint").alias("applied_events"))


def stream_spec_change(spark: SparkSession, sf: str) -> DataFrame:
    """Specs that change while the query runs: after half the batches one is deleted and one is new."""
    from tumbleweed.streaming.job import SpecSource, run_pane_stream_from_table

    now = {"specs": None}
    source = SpecSource(lambda: specs_from_json(spark, now["specs"]), lambda specs: FeatureJob(specs, tz=DAY_ZONE), every_s=0)

    def job_at(batch_id: int) -> FeatureJob:
        ids = {1, 4} if batch_id < 2 else {1, 7}
        now["specs"] = [s for s in EVENT_SPECS if s["id"] in ids]
        return source(batch_id)

    features = run_pane_stream_from_table(spark, sf, job_at)[1].where(F.col("source") == "windowed")
    return _typed(features).select("id", "feature_name", "ts", "value_long")


def _stream_sink(spark: SparkSession, sf: str, name: str, **options) -> DataFrame:
    from tumbleweed.streaming.job import catch_up_from_table

    job = _job(spark, {1, 4, 11, 13, 14})
    job.compiled = job.compiled.restrict_features([r.feature_name for r in job.compiled.rows["sink_fields"]])
    return spark.read.parquet(f"{catch_up_from_table(spark, sf, job, **options).sinks}/{name}")


def stream_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Serving cells as the stream's sink writer leaves them."""
    return _stream_sink(spark, sf, "cells").select("table", "row_key", "column", "ts", "value", "ttl_ms")


def stream_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Feature messages as the stream's sink writer leaves them."""
    return _stream_sink(spark, sf, "messages").select(
        "id", "id_type", "biz_type", "ts", F.size("kv").alias("n_columns"), F.explode("kv").alias("column", "value"))


def stream_message_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of batches of two rows, or a second, per entity, as the stream's sink writer leaves them."""
    return _stream_sink(spark, sf, "messages", message_rows=2).select(
        "id", "id_type", "biz_type", "ts", "batch", F.size("kv").alias("n_columns"), F.explode("kv").alias("column", "value"))


QUERIES = {
    "parse_events": parse_events_q,
    "dim_fanout": dim_fanout,
    "route_match": route_match,
    "atom_features": atom_features_q,
    "spec_validation": spec_validation,
    "pane_count": pane_count,
    "pane_count_grouped": pane_count_grouped,
    "rel_count": rel_count,
    "rel_count_grouped": rel_count_grouped,
    "rel_sum_long": rel_sum_long,
    "rel_sum_double": rel_sum_double,
    "rel_max": rel_max,
    "rel_min": rel_min,
    "recent_list": recent_list,
    "recent_list_ts": recent_list_ts,
    "recent_set": recent_set,
    "recent_set_ts": recent_set_ts,
    "recent_set_custom_time": recent_set_custom_time,
    "rel_sum_huge": rel_sum_huge,
    "prefixed_ids": prefixed_ids,
    "cell_snapshot_live": cell_snapshot_live,
    "latest_value": latest_value,
    "whole_today": whole_today,
    "whole_yesterday": whole_yesterday,
    "hourly_cadence": hourly_cadence,
    "second_cadence": second_cadence,
    "target_dims": target_dims,
    "session_partials": session_partials,
    "retention_panes": retention_panes,
    "all_features": all_features,
    "serving_cells": serving_cells_q,
    "cell_snapshot": cell_snapshot_q,
    "snapshot_incremental": snapshot_incremental,
    "feature_messages": feature_messages_q,
    "message_batches": message_batches_q,
    "output_counts": output_counts_q,
    "orders_spend_windows": orders_spend_windows,
    "lineitem_part_demand": lineitem_part_demand,
    "stream_panes": stream_panes,
    "stream_features": stream_features,
    "stream_recent": stream_recent,
    "stream_all_features": stream_all_features,
    "stream_retention": stream_retention,
    "stream_late_rows": stream_late_rows,
    "stream_spec_change": stream_spec_change,
    "stream_cells": stream_cells,
    "stream_messages": stream_messages,
    "stream_message_batches": stream_message_batches,
}
