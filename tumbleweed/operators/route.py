"""Event -> spec routing.

The route table has a row per spec, route and cadence.  Its rows are counted
when the specs are compiled; it is broadcast up to a limit (``BROADCAST_ROWS``)
and left to the planner beyond it.  One event fans out to every spec routed to its
(biz_type, event_type, target_type, id_type).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tumbleweed.functions.fields import field_value, lenient
from tumbleweed.operators.fanout import strip_id_prefix
from tumbleweed.plans.compile import CompiledSpecs, literal_table, spec_broadcast

ROUTE_KEYS = ["biz_type", "event_type", "target_type", "id_type"]


def route_windowed(fanned: DataFrame, cs: CompiledSpecs, *cadences: int, as_cadence: int | None = None) -> DataFrame:
    """Routed long rows for the windowed kinds at these pane cadences.

    Output: ``id, id_type, feature, kind, spec_id, cadence_ms, event_ms, val, grp,
    item_ms`` plus the spec parameters used by the pane build.  A spec routed at
    several cadences gives a row for each, from one scan; with ``as_cadence`` it
    gives one row, at that cadence.
    """
    table = spec_broadcast(cs.route_table(list(cadences), as_cadence), len(cs.rows["routes"]))
    joined = fanned.where(F.col("event_ms").isNotNull()).join(table, ROUTE_KEYS)
    ev = cs.expressions
    with lenient(fanned.sparkSession):
        return joined.select(
            strip_id_prefix(F.col("id")).alias("id"),
            "id_type", "feature", "kind", "spec_id", "cadence_ms", "event_ms",
            F.when(F.col("kind") != "count", field_value(F.col("field"), ev)).alias("val"),
            F.when(F.col("group_by").isNotNull(), field_value(F.col("group_by"), ev)).alias("grp"),
            F.col("group_by").isNotNull().alias("grouped"),
            F.when(F.col("kind").isin("list", "set", "latest"),
                   field_value(F.col("time_field"), ev).try_cast("bigint")).alias("item_ms"),
            "field_type", "capacity",
        )


def route_atoms(fanned: DataFrame, cs: CompiledSpecs) -> DataFrame:
    """Routed rows for atom specs: one row per (event, atom spec)."""
    atom_ids = [r.spec_id for r in cs.rows["specs"] if r.kind == "atom"]
    routes = [r for r in cs.rows["routes"] if r.cadence_ms is None and r.spec_id in atom_ids]
    table = literal_table(fanned.sparkSession, [(r.spec_id, r.biz_type, r.event_type, r.target_type, r.id_type)
                                                for r in routes],
                          "spec_id int, biz_type string, event_type string, target_type string, id_type string")
    return fanned.join(spec_broadcast(table, len(routes)), ROUTE_KEYS)
