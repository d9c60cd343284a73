"""Sinks: serving cells, latest-cell snapshot, feature messages, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tumbleweed.functions.scalars import row_key
from tumbleweed.plans.compile import CELL_SINK_TYPES, CompiledSpecs, spec_broadcast
from tumbleweed.session import sorted_collections


def serving_cells(features: DataFrame, cs: CompiledSpecs) -> DataFrame:
    """Mapped features -> ``(table, row_key, column, ts, value, ttl_ms)``.

    Unmapped features are not persisted.
    """
    mapping = spec_broadcast(cs.sink_fields.where(F.col("sink_type").isin(*CELL_SINK_TYPES)), len(cs.rows["sink_fields"]))
    joined = features.join(mapping, "feature_name")
    return joined.select(
        "table", row_key(F.col("id")).alias("row_key"), "column", "ts",
        F.col("value_text").alias("value"), "ttl_ms", "id", "id_type", "biz_type",
    )


def cell_snapshot(cells: DataFrame, as_of_ms=None, version: str | None = None) -> DataFrame:
    """Newest version of each cell (O2); TTL applied when ``as_of_ms`` is given (O3).

    ``version`` names a column (the stream's ``batch_id``) that tells which of
    two cells of one time was written later.  ``groupBy`` with partial
    aggregation: a hot cell ships one partial per task.
    """
    order = ["ts", *([version] if version else []), "value"]
    # the key with most values first: it alone decides most comparisons of the sorts
    snap = cells.groupBy("row_key", "column", "table").agg(
        F.max_by(F.struct("value", "ttl_ms"), F.struct(*order)).alias("v"),
        F.max("ts").alias("ts"),
    ).select("table", "row_key", "column", "ts", F.col("v.value").alias("value"),
             F.col("v.ttl_ms").alias("ttl_ms"),
             (F.col("ts") + F.col("v.ttl_ms")).alias("expires_at_ms"))
    if as_of_ms is not None:
        snap = snap.where(F.col("expires_at_ms").isNull() | (F.col("expires_at_ms") > F.lit(as_of_ms)))
    return snap


def feature_messages(cells: DataFrame, topic: str = "feature-out") -> DataFrame:
    """One JSON message per (entity, bizType, ts) with the renamed values.

    Output ``(topic, key, value)`` -- ready for a Kafka or file sink.  One
    exchange on the message key; a column written twice at the same instant
    keeps its greatest value, so the map never holds a duplicate key.
    """
    # times first: they alone decide most comparisons of the sorts
    keys = ["ts", "id", "id_type", "biz_type"]
    per_column = (cells.where(F.col("biz_type").isNotNull()).repartition(*keys)
                  .groupBy(*keys, "column").agg(F.max("value").alias("value")))
    grouped = per_column.groupBy(*keys).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("column", "value")))).alias("kv"))
    body = F.to_json(F.struct(
        F.col("id"), F.col("id_type").alias("dataType"), F.col("ts"),
        F.col("biz_type").alias("bizType"), F.col("kv")))
    return grouped.select(F.lit(topic).alias("topic"), F.col("id").alias("key"), body.alias("value"),
                          "id", "id_type", "biz_type", "ts", "kv")


def message_batches(cells: DataFrame, max_rows: int = 100, interval_ms: int = 1_000, topic: str = "feature-out") -> DataFrame:
    """Messages of count-or-timeout batches (W7, T3, O4): an entity's rows fire at ``max_rows``, or at the end of the interval.

    On the event clock: an entity's rows of one interval, in the order of their
    times, are cut after every ``max_rows``; each batch gives one message per bizType, in
    which the last time of a column wins.  Work is dealt by (entity, interval), so
    a busy entity is spread over its intervals; an array holds the rows of one batch.
    """
    entity = ["interval", "id", "id_type"]
    placed = cells.withColumn("interval", F.floor(F.col("ts") / F.lit(interval_ms)))
    before = F.row_number().over(Window.partitionBy(*entity).orderBy("ts", "column", "value")) - 1
    batch = [*entity, "batch", "biz_type"]
    fired = placed.withColumn("batch", F.floor(before / F.lit(max_rows))).where(F.col("biz_type").isNotNull())
    grouped = fired.groupBy(*batch).agg(F.max("ts").alias("ts"), F.sort_array(F.collect_list(F.struct("column", "ts", "value"))).alias("rows"))
    # in the order of columns and times: a row counts if the next one is of another column
    last = F.filter("rows", lambda r, i: F.get("rows", i + 1).isNull() | (F.get("rows", i + 1)["column"] != r["column"]))
    grouped = grouped.withColumn("last", last).withColumn("kv", F.map_from_arrays(F.col("last")["column"], F.col("last")["value"]))
    body = F.to_json(F.struct(F.col("id"), F.col("id_type").alias("dataType"), F.col("ts"), F.col("biz_type").alias("bizType"), F.col("kv")))
    return grouped.select(F.lit(topic).alias("topic"), F.col("id").alias("key"), body.alias("value"), "id", "id_type", "biz_type", "ts", "batch", "kv")


def output_counts(cells: DataFrame) -> DataFrame:
    """Persisted-feature counter per column."""
    return cells.groupBy("column").agg(F.count(F.lit(1)).alias("n"))


def _write_cells(features: DataFrame, cs: CompiledSpecs, root: str, part: str, message_rows: int | None) -> None:
    path = f"{root}/cells/{part}"
    serving_cells(features, cs).write.mode("overwrite").parquet(path)
    cells = features.sparkSession.read.parquet(path)
    messages = feature_messages(cells) if message_rows is None else message_batches(cells, message_rows)
    with sorted_collections(features.sparkSession):
        messages.write.mode("overwrite").parquet(f"{root}/messages/{part}")


#: Writers by sink type (O5): each takes (features, compiled specs, root folder, part, rows of a message batch) and replaces that part.
SINK_WRITERS = {kind: _write_cells for kind in CELL_SINK_TYPES}


def write_sinks(features: DataFrame, cs: CompiledSpecs, root: str, part: str, message_rows: int | None = None) -> list[str]:
    """Write the mapped features through the writer of each sink type the specs name.

    Cells go to ``<root>/cells/<part>``, and their messages to
    ``<root>/messages/<part>``; writing a part again replaces it, so a replayed
    batch leaves nothing twice.  ``message_rows`` makes a message for each batch of so
    many rows of an entity, or a second (:func:`message_batches`), instead of one for
    each time.  Returns the sink types that have no writer.
    """
    types = {r.sink_type for r in cs.rows["sink_fields"]}
    for writer in {SINK_WRITERS[t] for t in types if t in SINK_WRITERS}:
        writer(features, cs, root, part, message_rows)
    return sorted(str(t) for t in types if t not in SINK_WRITERS)
