"""JSON event parsing.

Events are schema-on-read JSON objects.  They are parsed once into a fixed
envelope plus two open string maps:

* ``attrs`` -- every top-level field (nested objects kept as JSON text), so a
  spec may name any top-level field;
* ``ext``   -- the ``ext`` object, where measures and secondary ids live.

Malformed records are not dropped silently: :func:`parse_events` returns the
good rows and a reject frame with the reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Reserved top-level field names of an event.
UID, EXT, BIZ_TYPE, EVENT_TYPE, TARGET_TYPE = "uid", "ext", "bizType", "eventType", "targetType"
DEFAULT_EVENT_TIME_FIELD = "ext.eventTime"

# Clocks outside the years 0001 to 9999 can be no event time: arithmetic on them overflows.
MIN_EVENT_MS, MAX_EVENT_MS = -62_135_596_800_000, 253_402_300_799_999

EVENT_COLUMNS = ["topic", "uid", "biz_type", "event_type", "target_type",
                 "event_ms", "ext", "attrs"]

_MAP = "map<string,string>"


def parse_events(records: DataFrame, event_time_field: str = DEFAULT_EVENT_TIME_FIELD,
                 with_rejects: bool = False):
    """``(topic, key, value)`` -> event envelope.

    ``event_ms`` (epoch ms, the pane clock, decision D1) is read from
    ``event_time_field`` (``ext.<key>`` or a top-level field).
    Returns the events, or ``(events, rejects)`` when ``with_rejects``.
    """
    # Each parse sits behind a one-element explode: predicates on the parsed
    # columns (event time, ids) then stay above it instead of being pushed
    # below with the parse inlined -- the JSON is decoded once per record.
    parsed = records.select(
        "topic", "value", F.explode(F.array(F.from_json(F.col("value"), _MAP))).alias("attrs"))
    parsed = parsed.select(
        "topic", "value", "attrs",
        F.explode(F.array(F.from_json(F.try_element_at(F.col("attrs"), F.lit(EXT)), _MAP))).alias("ext"))
    ext = F.col("ext")
    if event_time_field.startswith("ext."):
        raw_time = F.try_element_at(ext, F.lit(event_time_field[4:]))
    else:
        raw_time = F.try_element_at(F.col("attrs"), F.lit(event_time_field))
    top = lambda k: F.coalesce(F.try_element_at(F.col("attrs"), F.lit(k)), F.lit(""))
    shaped = parsed.select(
        "topic",
        "value",
        F.try_element_at(F.col("attrs"), F.lit(UID)).alias("uid"),
        top(BIZ_TYPE).alias("biz_type"),
        top(EVENT_TYPE).alias("event_type"),
        top(TARGET_TYPE).alias("target_type"),
        raw_time.try_cast("bigint").alias("event_ms"),
        "ext",
        "attrs",
    )
    # Rows without an event time stay: atom features do not need one; the
    # windowed path drops them before the pane build.
    reason = (F.when(F.col("attrs").isNull(), F.lit("malformed json"))
              .when(~F.col("event_ms").between(MIN_EVENT_MS, MAX_EVENT_MS), F.lit("clock out of range")))
    events = shaped.where(reason.isNull()).select(*EVENT_COLUMNS)
    if not with_rejects:
        return events
    rejects = shaped.where(reason.isNotNull()).select("topic", "value", reason.alias("reason"))
    return events, rejects
