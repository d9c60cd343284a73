"""The spec set used by the registered queries, tests and benchmark.

Specs are configuration: the events they run over come from the test tables
(see :mod:`tumbleweed.sources.standin`).  A few specs are invalid on purpose;
the compiler must reject exactly those and keep the rest (X3).
"""

from __future__ import annotations

SOCIAL = [{"bizType": "social", "eventType": t, "targetType": "user"}
          for t in ("signup", "view", "click", "error")]
PURCHASE = [{"bizType": "order", "eventType": "purchase", "targetType": "user"}]
ALL_EVENTS = SOCIAL + PURCHASE


def rel(*windows: str, delay: str = "1m") -> list[dict]:
    return [{"delay": delay, "window": w, "windowType": "relativeWindow"} for w in windows]


def whole(*windows: str, delay: str = "1m") -> list[dict]:
    return [{"delay": delay, "window": w, "windowType": "wholeWindow"} for w in windows]


def cells(table: str, mapping: dict[str, str], ttl: int = 86_400) -> list[dict]:
    return [{"type": "hbase",
             "fields": {name: {"table": table, "ttl": ttl, "rename": rename} for name, rename in mapping.items()}}]


EVENT_SPECS: list[dict] = [
    {"id": 1, "configType": "COUNT", "bizType": "social", "idType": "uid", "featureNamePrefix": "evt_cnt",
     "typeConfig": ALL_EVENTS, "aggConfig": {},
     "windows": rel("10m", "3h", "24h") + whole("today", "yesterday"),
     "sinks": cells("user_feature", {"evt_cnt_10m": "cnt_10m", "evt_cnt_3h": "", "evt_cnt_today": "cnt_today"})},
    {"id": 2, "configType": "count", "bizType": "social", "idType": "uid", "featureNamePrefix": "type_cnt",
     "typeConfig": ALL_EVENTS, "aggConfig": {"groupByField": "eventType"},
     "windows": rel("10m", "3h") + whole("today", "yesterday"), "sinks": []},
    {"id": 3, "configType": "SUM", "bizType": "order", "idType": "uid", "featureNamePrefix": "val_sum",
     "typeConfig": ALL_EVENTS, "aggConfig": {"field": "ext.value", "fieldType": "double"},
     "windows": rel("10m", "3h", "24h"), "sinks": []},
    {"id": 4, "configType": "SUM", "bizType": "", "idType": "uid", "featureNamePrefix": "k_sum",
     "typeConfig": ALL_EVENTS, "aggConfig": {"field": "ext.k", "fieldType": "long"},
     "windows": rel("10m", "3h", "24h") + whole("today", "yesterday"),
     "sinks": cells("user_feature", {"k_sum_24h": "k_24h"})},
    {"id": 5, "configType": "MAX", "bizType": "", "idType": "uid", "featureNamePrefix": "val_max",
     "typeConfig": ALL_EVENTS, "aggConfig": {"field": "ext.value", "fieldType": "double"},
     "windows": rel("10m", "3h", "24h"), "sinks": []},
    {"id": 6, "configType": "MIN", "bizType": "", "idType": "uid", "featureNamePrefix": "val_min",
     "typeConfig": ALL_EVENTS, "aggConfig": {"field": "ext.value", "fieldType": "double"},
     "windows": rel("10m", "3h", "24h"), "sinks": []},
    {"id": 7, "configType": "MAX", "bizType": "", "idType": "uid", "featureNamePrefix": "k_max",
     "typeConfig": ALL_EVENTS, "aggConfig": {"field": "ext.k", "fieldType": "long"},
     "windows": rel("3h", "60m", "1h"), "sinks": []},
    {"id": 8, "configType": "MIN", "bizType": "", "idType": "uid", "featureNamePrefix": "k_min",
     "typeConfig": ALL_EVENTS, "aggConfig": {"field": "ext.k", "fieldType": "long"},
     "windows": rel("3h"), "sinks": []},
    {"id": 9, "configType": "LIST", "bizType": "", "idType": "uid", "featureNamePrefix": "recent_k",
     "typeConfig": ALL_EVENTS, "aggConfig": {"field": "ext.k", "capacity": 5, "needTs": False},
     "windows": rel("3h", "24h"), "sinks": []},
    {"id": 10, "configType": "LIST", "bizType": "", "idType": "uid", "featureNamePrefix": "recent_k_ts",
     "typeConfig": ALL_EVENTS, "aggConfig": {"field": "ext.k", "capacity": 3, "needTs": True,
                                             "eventTimeField": "ext.eventTime"},
     "windows": rel("24h"), "sinks": []},
    {"id": 11, "configType": "SET", "bizType": "social", "idType": "uid", "featureNamePrefix": "recent_type",
     "typeConfig": ALL_EVENTS, "aggConfig": {"field": "eventType", "capacity": 3},
     "windows": rel("24h"), "sinks": cells("user_feature", {"recent_type_24h": "recent_types"})},
    {"id": 12, "configType": "SET", "bizType": "", "idType": "uid", "featureNamePrefix": "recent_type_ts",
     "typeConfig": ALL_EVENTS, "aggConfig": {"field": "eventType", "capacity": 2, "needTs": True},
     "windows": rel("3h"), "sinks": []},
    {"id": 13, "configType": "LATEST", "bizType": "social", "idType": "uid", "featureNamePrefix": "last_type",
     "typeConfig": ALL_EVENTS, "aggConfig": {"field": "eventType"},
     "windows": rel("10m"), "sinks": cells("user_feature", {"last_type": "last_type"})},
    {"id": 14, "configType": "ATOM", "bizType": "social", "idType": "uid", "featureNamePrefix": "evt",
     "typeConfig": ALL_EVENTS,
     "aggConfig": {"fields": [{"sourceField": "ext.value", "featureName": "value"},
                              {"sourceField": "eventType", "featureName": "type"},
                              {"sourceField": "ext.k * 10", "featureName": "k10"}]},
     "windows": [], "sinks": cells("user_atom", {"evt_type": "type"}, ttl=0)},
    {"id": 15, "configType": "COUNT", "bizType": "order", "idType": "targetUid", "featureNamePrefix": "tgt_buy_cnt",
     "typeConfig": PURCHASE, "aggConfig": {}, "windows": rel("24h"), "sinks": []},
    {"id": 16, "configType": "COUNT", "bizType": "", "idType": "anchorUid", "featureNamePrefix": "anchor_cnt",
     "typeConfig": SOCIAL, "aggConfig": {}, "windows": rel("10m", "3h"), "sinks": []},
    {"id": 17, "configType": "COUNT", "bizType": "", "idType": "uid", "featureNamePrefix": "evt_cnt_hourly",
     "typeConfig": ALL_EVENTS, "aggConfig": {}, "windows": rel("3h", "24h", delay="1h"), "sinks": []},
    {"id": 18, "configType": "COUNT", "bizType": "", "idType": "uid", "featureNamePrefix": "evt_cnt_sliding",
     "typeConfig": ALL_EVENTS, "aggConfig": {}, "windows": rel("5m", delay="1s"), "sinks": []},
    # --- invalid on purpose (X2, X3, D3, D10, D12, D17) -------------------------
    {"id": 90, "configType": "MEDIAN", "idType": "uid", "featureNamePrefix": "bad_kind",
     "typeConfig": ALL_EVENTS, "aggConfig": {"field": "ext.value"}, "windows": rel("10m")},
    {"id": 91, "configType": "SUM", "idType": "uid", "featureNamePrefix": "bad_type",
     "typeConfig": ALL_EVENTS, "aggConfig": {"field": "ext.value", "fieldType": "int"}, "windows": rel("10m")},
    {"id": 92, "configType": "COUNT", "idType": "uid", "featureNamePrefix": "bad_window",
     "typeConfig": ALL_EVENTS, "aggConfig": {}, "windows": rel("10x")},
    {"id": 93, "configType": "LIST", "idType": "uid", "featureNamePrefix": "bad_capacity",
     "typeConfig": ALL_EVENTS, "aggConfig": {"field": "ext.k"}, "windows": rel("10m")},
    {"id": 94, "configType": "COUNT", "idType": "uid", "featureNamePrefix": "bad_whole",
     "typeConfig": ALL_EVENTS, "aggConfig": {}, "windows": whole("lastweek")},
    {"id": 95, "configType": "COUNT", "idType": "uid", "featureNamePrefix": "evt_cnt",
     "typeConfig": ALL_EVENTS, "aggConfig": {}, "windows": rel("10m")},
]

# The errors the compiler must report for the invalid specs above.
EXPECTED_ERRORS = {
    90: "unknown kind: median",
    91: "bad fieldType: int",
    92: "bad window: 10x",
    93: "capacity must be >= 1",
    94: "unknown whole window: lastweek",
    95: "duplicate featureNamePrefix for idType",
}


# Cases at the edges: item times that are not the pane clock, sums near the end of their type.
EDGE_SPECS: list[dict] = [
    {"id": 301, "configType": "SET", "bizType": "", "idType": "uid", "featureNamePrefix": "type_by_k",
     "typeConfig": ALL_EVENTS, "aggConfig": {"field": "eventType", "capacity": 2, "needTs": True, "eventTimeField": "ext.k"},
     "windows": rel("3h", "24h"), "sinks": []},
    {"id": 302, "configType": "SUM", "bizType": "", "idType": "uid", "featureNamePrefix": "k_huge",
     "typeConfig": ALL_EVENTS, "aggConfig": {"field": "ext.k * 90000000000000000", "fieldType": "long"},
     "windows": rel("10m", "3h", "24h"), "sinks": []},
]


ORDER_PLACED = [{"bizType": "order", "eventType": "placed", "targetType": "shop"}]
ORDER_SPECS: list[dict] = [
    {"id": 101, "configType": "COUNT", "bizType": "order", "idType": "uid", "featureNamePrefix": "cust_orders",
     "typeConfig": ORDER_PLACED, "aggConfig": {}, "windows": rel("7d", "30d"), "sinks": []},
    {"id": 102, "configType": "SUM", "bizType": "order", "idType": "uid", "featureNamePrefix": "cust_spend",
     "typeConfig": ORDER_PLACED, "aggConfig": {"field": "ext.price", "fieldType": "double"},
     "windows": rel("7d", "30d"), "sinks": []},
    {"id": 103, "configType": "MAX", "bizType": "order", "idType": "uid", "featureNamePrefix": "cust_max_order",
     "typeConfig": ORDER_PLACED, "aggConfig": {"field": "ext.price", "fieldType": "double"},
     "windows": rel("30d"), "sinks": []},
    {"id": 104, "configType": "COUNT", "bizType": "order", "idType": "uid", "featureNamePrefix": "cust_status",
     "typeConfig": ORDER_PLACED, "aggConfig": {"groupByField": "ext.status"}, "windows": rel("30d"), "sinks": []},
]

LINE_SHIPPED = [{"bizType": "order", "eventType": "shipped", "targetType": "part"}]
LINEITEM_SPECS: list[dict] = [
    {"id": 201, "configType": "SUM", "bizType": "order", "idType": "uid", "featureNamePrefix": "supp_qty",
     "typeConfig": LINE_SHIPPED, "aggConfig": {"field": "ext.qty", "fieldType": "double"},
     "windows": rel("7d", "30d"), "sinks": []},
    {"id": 202, "configType": "COUNT", "bizType": "order", "idType": "uid", "featureNamePrefix": "supp_flag",
     "typeConfig": LINE_SHIPPED, "aggConfig": {"groupByField": "ext.flag"}, "windows": rel("30d"), "sinks": []},
    {"id": 203, "configType": "LIST", "bizType": "order", "idType": "uid", "featureNamePrefix": "supp_parts",
     "typeConfig": LINE_SHIPPED, "aggConfig": {"field": "ext.targetUid", "capacity": 3}, "windows": rel("7d"),
     "sinks": []},
    {"id": 204, "configType": "COUNT", "bizType": "order", "idType": "targetUid", "featureNamePrefix": "part_ships",
     "typeConfig": LINE_SHIPPED, "aggConfig": {}, "windows": rel("30d"), "sinks": []},
]
