"""DISTINCT: exact counts of distinct whole numbers in a look-back, a kind added to the engine from outside.

A pane's state is a set of bitmaps: value ``v`` is bit ``v mod 64`` of bucket ``v div 64``
(rounding down), which is the sub key.  Bitmaps merge by OR, so panes, batches and
look-backs do, and nothing is counted twice.  A bucket is one word of 8 bytes: there are
never more of them than values, and aggregates of them have buffers of fixed width.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tumbleweed.operators.rollup import rollup_states
from tumbleweed.oracle_sql import DAY, EV, HOUR, MIN
from tumbleweed.plans.catalog import ALL_EVENTS, SOCIAL, rel
from tumbleweed.plans.job import FeatureJob
from tumbleweed.plans.kinds import FeatureKind, PaneState, register_kind
from tumbleweed.sources.specs import specs_from_json
from tumbleweed.sources.standin import event_records


def _value():
    return F.col("val").try_cast("bigint")


def _word(state):
    """The bitmap in a state (8 bytes) as a number."""
    return F.conv(F.hex(state), 16, -10).cast("bigint")


def _state(word):
    return F.unhex(F.lpad(F.hex(word), 16, "0"))


def _error(spec: dict) -> str | None:
    if spec["field_type"] != "long":
        return "DISTINCT needs fieldType long"
    if not spec["field"]:
        return "missing aggConfig.field"
    if any(w["is_whole"] for w in spec["windows"]):
        return "DISTINCT has no whole windows"
    return None


DISTINCT = register_kind(FeatureKind(
    "distinct", lambda spec: spec.kind == "distinct",
    lambda panes, specs, pane_ms, tz, clock: rollup_states(panes, specs, pane_ms, "distinct", F.bit_count),
    validate=_error,
    pane=PaneState(keep=lambda: _value().isNotNull(), sub_key=lambda: F.shiftright(_value(), 6).cast("string"),
                   partial=lambda: _state(F.bit_or(F.expr("shiftleft(1L, CAST(try_cast(val AS BIGINT) & 63 AS INT))"))),
                   combine=lambda state: _state(F.bit_or(_word(state))), read=_word, merge=F.bit_or)))

SPECS = [
    {"id": 201, "configType": "DISTINCT", "bizType": "", "idType": "uid", "featureNamePrefix": "k_distinct", "typeConfig": ALL_EVENTS,
     "aggConfig": {"field": "ext.k", "fieldType": "long"}, "windows": rel("10m", "3h", "24h"), "sinks": []},
    # far apart and below zero: many buckets
    {"id": 202, "configType": "DISTINCT", "bizType": "", "idType": "anchorUid", "featureNamePrefix": "wide_distinct", "typeConfig": SOCIAL,
     "aggConfig": {"field": "(ext.k - 5) * 20000", "fieldType": "long"}, "windows": rel("10m"), "sinks": []},
]


def distinct_count(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct values in look-backs, by the added kind."""
    job = FeatureJob(specs_from_json(spark, SPECS), tz="UTC")
    return job.features(event_records(spark, sf)).select("id", "feature_name", "ts", "value_long")


def _looked_back(name: str, width: int, entity: str, where: str) -> str:
    rows = f"(SELECT DISTINCT {entity} AS id, (event_ms // {MIN} + 1) * {MIN} AS pe, k FROM ev WHERE {where})"
    return (f"SELECT a.id, '{name}' AS feature_name, a.pe AS ts, count(DISTINCT b.k) AS value_long FROM (SELECT DISTINCT id, pe FROM {rows}) a "
            f"JOIN {rows} b ON a.id = b.id AND b.pe <= a.pe AND b.pe > a.pe - {width} GROUP BY a.id, a.pe")


QUERIES = {"distinct_count": distinct_count}
ORACLES = {"distinct_count": f"WITH {EV} " + " UNION ALL ".join(
    [_looked_back(f"k_distinct_{n}", w, "uid", "k IS NOT NULL") for n, w in (("10m", 10 * MIN), ("3h", 3 * HOUR), ("24h", DAY))]
    + [_looked_back("wide_distinct_10m", 10 * MIN, "CAST(anchor AS VARCHAR)", "k IS NOT NULL AND biz_type = 'social'")])}
