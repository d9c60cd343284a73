"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark code: plain SQL over the raw tables with
the canonical event mapping of :mod:`tumbleweed.sources.standin` spelled out
again, window frames for look-backs, range joins for carried-over groups and
recent-item lists.  Sums of doubles are taken as DECIMAL(18,2) so they are
exact; the Spark side reports the same values rounded to cents.
"""

from __future__ import annotations

MIN, HOUR, DAY = 60_000, 3_600_000, 86_400_000

EV = """
ev AS (
  SELECT event_id,
         CASE WHEN event_type = 'purchase' THEN 'ORDER' ELSE 'LIVEROOM' END AS topic,
         CAST(user_id AS VARCHAR) AS uid,
         CASE WHEN event_type = 'purchase' THEN 'order' ELSE 'social' END AS biz_type,
         event_type,
         'user' AS target_type,
         (epoch_us(ts) // 1000) AS event_ms,
         value AS v,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         event_id % 7 AS anchor
  FROM events
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def _pane(ms: int, pane: int = MIN) -> str:
    return f"(({ms}) // {pane} + 1) * {pane}"


def _union(*selects: str) -> str:
    return "\nUNION ALL\n".join(selects)


def _out(id_expr="id", name="feature_name", ts="ts", vl="NULL", vd="NULL", vt="NULL"):
    return (f"{id_expr} AS id, {name} AS feature_name, {ts} AS ts, CAST({vl} AS BIGINT) AS value_long, "
            f"CAST({vd} AS DOUBLE) AS value_double, CAST({vt} AS VARCHAR) AS value_text")


def _frame(agg: str, width: int, part: str = "id", order: str = "pe") -> str:
    return f"{agg} OVER (PARTITION BY {part} ORDER BY {order} RANGE BETWEEN {width - 1} PRECEDING AND CURRENT ROW)"


# --------------------------------------------------------------------------- sources / routing
PARSE_EVENTS = _with(EV) + """
SELECT topic, uid, biz_type, event_type, target_type, event_ms,
       CAST(v AS VARCHAR) AS ext_value, CAST(k AS VARCHAR) AS ext_k, CAST(anchor AS VARCHAR) AS ext_anchor
FROM ev"""

DIM_FANOUT = _with(EV) + _union(
    "SELECT topic, 'uid' AS id_type, uid AS id, event_ms, event_type FROM ev",
    "SELECT topic, 'targetUid', CAST(k AS VARCHAR), event_ms, event_type FROM ev",
    "SELECT topic, 'anchorUid', CAST(anchor AS VARCHAR), event_ms, event_type FROM ev WHERE topic = 'LIVEROOM'",
)

# routes of the valid 1-minute specs: (spec_id, feature, id_type, which events)
_UID_MINUTE_SPECS = [(1, "evt_cnt"), (2, "type_cnt"), (3, "val_sum"), (4, "k_sum"), (5, "val_max"),
                     (6, "val_min"), (7, "k_max"), (8, "k_min"), (9, "recent_k"), (10, "recent_k_ts"),
                     (11, "recent_type"), (12, "recent_type_ts"), (13, "last_type")]


def _fanned() -> str:
    return """fan AS (
  SELECT topic, 'uid' AS id_type, uid AS id, event_ms, biz_type, event_type, target_type FROM ev
  UNION ALL SELECT topic, 'targetUid', CAST(k AS VARCHAR), event_ms, biz_type, event_type, target_type FROM ev
  UNION ALL SELECT topic, 'anchorUid', CAST(anchor AS VARCHAR), event_ms, biz_type, event_type, target_type
            FROM ev WHERE topic = 'LIVEROOM'
)"""


def _route_values() -> str:
    rows = []
    all_types = ["signup", "view", "click", "error", "purchase"]
    for sid, feat in _UID_MINUTE_SPECS:
        for t in all_types:
            biz = "order" if t == "purchase" else "social"
            rows.append(f"({sid}, '{feat}', '{biz}', '{t}', 'user', 'uid')")
    rows.append("(15, 'tgt_buy_cnt', 'order', 'purchase', 'user', 'targetUid')")
    for t in ["signup", "view", "click", "error"]:
        rows.append(f"(16, 'anchor_cnt', 'social', '{t}', 'user', 'anchorUid')")
    return ("routes AS (SELECT * FROM (VALUES " + ", ".join(rows) +
            ") r(spec_id, feature, biz_type, event_type, target_type, id_type))")


ROUTE_MATCH = _with(EV, _fanned(), _route_values()) + """
SELECT r.spec_id, r.feature, f.id, f.id_type, f.event_ms
FROM fan f JOIN routes r USING (biz_type, event_type, target_type, id_type)"""

ATOM_FEATURES = _with(EV) + _union(
    "SELECT uid AS id, 'uid' AS id_type, 'evt_value' AS feature_name, event_ms AS ts, CAST(v AS VARCHAR) AS value FROM ev",
    "SELECT uid, 'uid', 'evt_type', event_ms, event_type FROM ev",
    "SELECT uid, 'uid', 'evt_k10', event_ms, CAST(k * 10 AS VARCHAR) FROM ev",
)

_ERRORS = [(90, "bad_kind", "unknown kind: median"), (91, "bad_type", "bad fieldType: int"),
           (92, "bad_window", "bad window: 10x"), (93, "bad_capacity", "capacity must be >= 1"),
           (94, "bad_whole", "unknown whole window: lastweek"),
           (95, "evt_cnt", "duplicate featureNamePrefix for idType")]

SPEC_VALIDATION = _with(EV, _fanned(), _route_values().replace("routes AS", "routes1 AS"), """
specs AS (SELECT * FROM (VALUES """ + ", ".join(
    [f"({i}, '{f}')" for i, f in _UID_MINUTE_SPECS] +
    ["(14, 'evt')", "(15, 'tgt_buy_cnt')", "(16, 'anchor_cnt')", "(17, 'evt_cnt_hourly')",
     "(18, 'evt_cnt_sliding')"] + [f"({i}, '{f}')" for i, f, _ in _ERRORS]) + """) s(spec_id, feature))""",
    """errs AS (SELECT * FROM (VALUES """ + ", ".join(f"({i}, '{e}')" for i, _, e in _ERRORS) + """) e(spec_id, error))""",
    """routes AS (
  SELECT DISTINCT spec_id, biz_type, event_type, target_type, id_type FROM routes1
  UNION ALL SELECT DISTINCT s, biz_type, event_type, target_type, id_type FROM routes1,
       (VALUES (14), (17), (18)) x(s) WHERE spec_id = 1
)""",
    """counts AS (SELECT r.spec_id, count(*) AS n FROM fan f JOIN routes r USING (biz_type, event_type, target_type, id_type)
           GROUP BY r.spec_id)""") + """
SELECT s.spec_id, s.feature, e.error, CAST(COALESCE(c.n, 0) AS BIGINT) AS routed_events
FROM specs s LEFT JOIN errs e USING (spec_id) LEFT JOIN counts c USING (spec_id)"""


# --------------------------------------------------------------------------- panes
PANE_COUNT = _with(EV) + f"""
SELECT uid AS id, 'uid' AS id_type, 'evt_cnt' AS feature, {_pane('event_ms')} AS pane_end_ms, count(*) AS cnt
FROM ev GROUP BY ALL"""

PANE_COUNT_GROUPED = _with(EV) + f"""
SELECT uid AS id, 'uid' AS id_type, 'type_cnt' AS feature, event_type AS sub_key,
       {_pane('event_ms')} AS pane_end_ms, count(*) AS cnt
FROM ev GROUP BY ALL"""

_SESSION_KEYS = ["evt_cnt", "type_cnt", "k_sum", "k_max", "k_min", "recent_k", "recent_type", "last_type"]
_SESSION_VALUE = ("CASE feature WHEN 'k_sum' THEN sum(k) WHEN 'k_max' THEN max(k) WHEN 'k_min' THEN min(k) END")
SESSION_PARTIALS = _with(EV, f"""
r AS (SELECT uid, event_ms, k, event_type, f.feature, CASE WHEN f.feature = 'type_cnt' THEN event_type ELSE '' END AS sub_key,
             CASE f.feature WHEN 'recent_k' THEN CAST(k AS VARCHAR) WHEN 'recent_type' THEN event_type WHEN 'last_type' THEN event_type END AS item
      FROM ev, (VALUES {", ".join(f"('{k}')" for k in _SESSION_KEYS)}) f(feature))""", """
s AS (SELECT *, CASE WHEN event_ms - lag(event_ms) OVER (PARTITION BY uid, feature, sub_key ORDER BY event_ms) < 600000
                     THEN 0 ELSE 1 END AS fresh FROM r)""", """
g AS (SELECT *, sum(fresh) OVER (PARTITION BY uid, feature, sub_key ORDER BY event_ms ROWS UNBOUNDED PRECEDING) AS sid FROM s)""", f"""
sess AS (SELECT uid, feature, sub_key, sid, min(event_ms) AS st, max(event_ms) + 600000 AS en, count(*) AS cnt, {_SESSION_VALUE} AS x
         FROM g GROUP BY uid, feature, sub_key, sid)""", """
e AS (SELECT uid, feature, sub_key, sid, item, max(event_ms) AS t FROM g WHERE item IS NOT NULL
      GROUP BY uid, feature, sub_key, sid, item, CASE WHEN feature = 'recent_k' THEN event_ms END)""", """
n AS (SELECT *, row_number() OVER (PARTITION BY uid, feature, sid ORDER BY t DESC, item DESC) AS rn FROM e)""", """
i AS (SELECT uid, feature, sub_key, sid,
             '[' || string_agg('{"ts":' || CAST(t AS VARCHAR) || ',"value":"' || item || '"}', ',' ORDER BY rn) || ']' AS items
      FROM n WHERE rn <= CASE feature WHEN 'recent_k' THEN 5 WHEN 'recent_type' THEN 3 ELSE 1 END GROUP BY ALL)""") + """
SELECT uid AS id, 'uid' AS id_type, feature, sub_key, st AS session_start_ms, en AS session_end_ms, cnt,
       CAST(x AS BIGINT) AS num_long, items
FROM sess LEFT JOIN i USING (uid, feature, sub_key, sid)"""

_RETAIN = {"evt_cnt": 2 * DAY, "type_cnt": 2 * DAY, "k_sum": 2 * DAY, "recent_k": DAY}
RETENTION_PANES = _with(EV, f"""
p AS (
  SELECT DISTINCT uid AS id, 'uid' AS id_type, f.feature, CASE WHEN f.feature = 'type_cnt' THEN event_type ELSE '' END AS sub_key,
         {_pane('event_ms')} AS pane_end_ms, f.keep
  FROM ev, (VALUES {", ".join(f"('{k}', {v})" for k, v in _RETAIN.items())}) f(feature, keep)
)""") + """
SELECT id, id_type, feature, sub_key, pane_end_ms FROM p
WHERE pane_end_ms > (SELECT max(event_ms) FROM ev) - keep"""


# --------------------------------------------------------------------------- numeric roll-ups
def _numeric(prefix: str, value_expr: str, agg: str, windows: dict[str, int], kind: str,
             filt: str = "TRUE", id_expr: str = "uid", src: str = "ev", time: str = "event_ms",
             pane: int = MIN) -> tuple[str, str]:
    """CTE + select for an ungrouped numeric roll-up over RANGE frames."""
    partial = {"sum": f"sum({value_expr})", "max": f"max({value_expr})", "min": f"min({value_expr})",
               "count": "count(*)"}[agg]
    cte = (f"p_{prefix} AS (SELECT {id_expr} AS id, {_pane(time, pane)} AS pe, {partial} AS x "
           f"FROM {src} WHERE {filt} GROUP BY ALL)")
    roll = "sum" if agg in ("sum", "count") else agg
    selects = []
    for name, width in windows.items():
        val = _frame(f"{roll}(x)", width)
        # a long sum beyond its type is NULL
        vl, vd = (f"TRY_CAST({val} AS BIGINT)", "NULL") if kind == "long" else ("NULL", val)
        selects.append(f"SELECT {_out(name=repr(prefix + '_' + name), ts='pe', vl=vl, vd=vd)} FROM p_{prefix}")
    return cte, _union(*selects)


def _q(*parts: tuple[str, str], extra: tuple[str, ...] = (EV,)) -> str:
    return _with(*extra, *[c for c, _ in parts]) + _union(*[s for _, s in parts])


W3 = {"10m": 10 * MIN, "3h": 3 * HOUR, "24h": DAY}
REL_COUNT = _q(_numeric("evt_cnt", "", "count", W3, "long"))
REL_SUM_LONG = _q(_numeric("k_sum", "k", "sum", W3, "long"))
REL_SUM_DOUBLE = _q(_numeric("val_sum", "CAST(v AS DECIMAL(18,2))", "sum", W3, "double"))
REL_MAX = _q(_numeric("val_max", "v", "max", W3, "double"),
             _numeric("k_max", "k", "max", {"3h": 3 * HOUR, "60m": HOUR, "1h": HOUR}, "long"))
REL_MIN = _q(_numeric("val_min", "v", "min", W3, "double"), _numeric("k_min", "k", "min", {"3h": 3 * HOUR}, "long"))
HOURLY_CADENCE = _q(_numeric("evt_cnt_hourly", "", "count", {"3h": 3 * HOUR, "24h": DAY}, "long", pane=HOUR))
SECOND_CADENCE = _q(_numeric("evt_cnt_sliding", "", "count", {"5m": 5 * MIN}, "long", pane=1000))
TARGET_DIMS = _q(
    _numeric("tgt_buy_cnt", "", "count", {"24h": DAY}, "long", filt="event_type = 'purchase'",
             id_expr="CAST(k AS VARCHAR)"),
    _numeric("anchor_cnt", "", "count", {"10m": 10 * MIN, "3h": 3 * HOUR}, "long",
             filt="event_type <> 'purchase'", id_expr="CAST(anchor AS VARCHAR)"),
)


def _grouped(prefix: str, group_expr: str, windows: dict[str, int], id_expr: str = "uid", src: str = "ev",
             time: str = "event_ms") -> tuple[str, str]:
    cte = f"""gp_{prefix} AS (SELECT {id_expr} AS id, {group_expr} AS g, {_pane(time)} AS pe, count(*) AS c
                FROM {src} GROUP BY ALL),
act_{prefix} AS (SELECT DISTINCT id, pe FROM gp_{prefix}),
w_{prefix} AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {ms})" for n, ms in windows.items())}) t(name, ms))"""
    sel = (f"SELECT {_out(id_expr='a.id', name=repr(prefix + '_') + ' || h.g || ' + repr('_') + ' || w.name', ts='a.pe', vl='sum(h.c)')} "
           f"FROM act_{prefix} a CROSS JOIN w_{prefix} w JOIN gp_{prefix} h ON h.id = a.id AND h.pe > a.pe - w.ms "
           f"AND h.pe <= a.pe GROUP BY a.id, h.g, w.name, a.pe")
    return cte, sel


REL_COUNT_GROUPED = _q(_grouped("type_cnt", "event_type", {"10m": 10 * MIN, "3h": 3 * HOUR}))


def _items(prefix: str, windows: dict[str, int], cap: int, need_ts: bool, distinct_values: bool,
           val_expr: str, id_expr: str = "uid", src: str = "ev", time: str = "event_ms") -> tuple[str, str]:
    text = "val || '|' || CAST(t AS VARCHAR)" if need_ts else "val"
    if distinct_values:
        picked = f"""SELECT a.id, a.pe, w.name, i.val, max(i.t) AS t
             FROM act_{prefix} a CROSS JOIN w_{prefix} w JOIN it_{prefix} i
               ON i.id = a.id AND i.pe > a.pe - w.ms AND i.pe <= a.pe GROUP BY ALL"""
    else:
        picked = f"""SELECT a.id, a.pe, w.name, i.val, i.t
             FROM act_{prefix} a CROSS JOIN w_{prefix} w JOIN it_{prefix} i
               ON i.id = a.id AND i.pe > a.pe - w.ms AND i.pe <= a.pe"""
    cte = f"""it_{prefix} AS (SELECT DISTINCT {id_expr} AS id, {val_expr} AS val, {time} AS t, {_pane('event_ms')} AS pe FROM {src}),
act_{prefix} AS (SELECT DISTINCT id, pe FROM it_{prefix}),
w_{prefix} AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {ms})" for n, ms in windows.items())}) t(name, ms)),
r_{prefix} AS (SELECT *, row_number() OVER (PARTITION BY id, pe, name ORDER BY t DESC, val DESC) AS rn
          FROM ({picked}) x)"""
    sel = (f"SELECT {_out(name=repr(prefix + '_') + ' || name', ts='pe', vt=f'to_json(list({text} ORDER BY t DESC, val DESC))')} "
           f"FROM r_{prefix} WHERE rn <= {cap} GROUP BY id, name, pe")
    return cte, sel


RECENT_LIST = _q(_items("recent_k", {"3h": 3 * HOUR, "24h": DAY}, 5, False, False, "CAST(k AS VARCHAR)"))
RECENT_LIST_TS = _q(_items("recent_k_ts", {"24h": DAY}, 3, True, False, "CAST(k AS VARCHAR)"))
RECENT_SET = _q(_items("recent_type", {"24h": DAY}, 3, False, True, "event_type"))
RECENT_SET_TS = _q(_items("recent_type_ts", {"3h": 3 * HOUR}, 2, True, True, "event_type"))

# item times that are not the pane clock
RECENT_SET_CUSTOM_TIME = _q(_items("type_by_k", {"3h": 3 * HOUR, "24h": DAY}, 2, True, True, "event_type", time="k"))
# running totals far beyond BIGINT, most windows inside it
REL_SUM_HUGE = _q(_numeric("k_huge", "CAST(k AS HUGEINT) * 90000000000000000", "sum", W3, "long"))
# ids 'acct:<n>' lose their prefix; every seventh event has an id of white space
PREFIXED_IDS = _q(_numeric("evt_cnt", "", "count", W3, "long", filt="anchor <> 0"))

LATEST_VALUE = _with(EV, f"""
l AS (SELECT uid AS id, {_pane('event_ms')} AS pe, event_type,
             row_number() OVER (PARTITION BY uid, {_pane('event_ms')} ORDER BY event_ms DESC, event_type DESC) AS rn
      FROM ev)""") + f"SELECT {_out(name=repr('last_type'), ts='pe', vt='event_type')} FROM l WHERE rn = 1"


def _whole(prefix: str, partial: str, which: str) -> tuple[str, str]:
    cte = (f"d_{prefix}_{which} AS (SELECT uid AS id, {_pane('event_ms')} AS pe, "
           f"(({_pane('event_ms')}) - {MIN}) // {DAY} AS day, {partial} AS x FROM ev GROUP BY ALL)")
    if which == "today":
        val = f"sum(x) OVER (PARTITION BY id, day ORDER BY pe ROWS UNBOUNDED PRECEDING)"
        sel = f"SELECT {_out(name=repr(prefix + '_today'), ts='pe', vl=val)} FROM d_{prefix}_{which}"
    else:
        val = f"sum(x) OVER (PARTITION BY id ORDER BY day RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING)"
        sel = (f"SELECT * FROM (SELECT {_out(name=repr(prefix + '_yesterday'), ts='pe', vl=val)} "
               f"FROM d_{prefix}_{which}) WHERE value_long IS NOT NULL")
    return cte, sel


def _whole_grouped(which: str) -> tuple[str, str]:
    cte = f"""wg_{which} AS (SELECT uid AS id, event_type AS g, {_pane('event_ms')} AS pe,
                  (({_pane('event_ms')}) - {MIN}) // {DAY} AS day, count(*) AS c FROM ev GROUP BY ALL),
wa_{which} AS (SELECT DISTINCT id, pe, day FROM wg_{which})"""
    cond = "h.day = a.day AND h.pe <= a.pe" if which == "today" else "h.day = a.day - 1"
    sel = (f"SELECT {_out(id_expr='a.id', name=repr('type_cnt_') + ' || h.g || ' + repr('_' + which), ts='a.pe', vl='sum(h.c)')} "
           f"FROM wa_{which} a JOIN wg_{which} h ON h.id = a.id AND {cond} GROUP BY a.id, h.g, a.pe")
    return cte, sel


WHOLE_TODAY = _q(_whole("evt_cnt", "count(*)", "today"), _whole("k_sum", "sum(k)", "today"), _whole_grouped("today"))
WHOLE_YESTERDAY = _q(_whole("evt_cnt", "count(*)", "yesterday"), _whole("k_sum", "sum(k)", "yesterday"),
                     _whole_grouped("yesterday"))


# --------------------------------------------------------------------------- other tables
ORD = """
od AS (SELECT CAST(o_custkey AS VARCHAR) AS uid, (epoch_us(o_orderdate) // 1000) AS event_ms, o_totalprice AS price,
              o_orderstatus AS status FROM orders)"""
ORDERS_SPEND_WINDOWS = _q(
    _numeric("cust_orders", "", "count", {"7d": 7 * DAY, "30d": 30 * DAY}, "long", src="od"),
    _numeric("cust_spend", "CAST(price AS DECIMAL(18,2))", "sum", {"7d": 7 * DAY, "30d": 30 * DAY}, "double", src="od"),
    _numeric("cust_max_order", "price", "max", {"30d": 30 * DAY}, "double", src="od"),
    _grouped("cust_status", "status", {"30d": 30 * DAY}, src="od"),
    extra=(ORD,),
)

LI = """
li AS (SELECT CAST(l_suppkey AS VARCHAR) AS uid, CAST(l_partkey AS VARCHAR) AS part, (epoch_us(l_shipdate) // 1000) AS event_ms,
              l_quantity AS qty, l_returnflag AS flag FROM lineitem)"""
LINEITEM_PART_DEMAND = _q(
    _numeric("supp_qty", "CAST(qty AS DECIMAL(18,2))", "sum", {"7d": 7 * DAY, "30d": 30 * DAY}, "double", src="li"),
    _grouped("supp_flag", "flag", {"30d": 30 * DAY}, src="li"),
    _items("supp_parts", {"7d": 7 * DAY}, 3, False, False, "part", src="li"),
    _numeric("part_ships", "", "count", {"30d": 30 * DAY}, "long", src="li", id_expr="part"),
    extra=(LI,),
)


# --------------------------------------------------------------------------- everything at 1 minute
def _all_parts() -> list[tuple[str, str]]:
    return [
        _numeric("evt_cnt", "", "count", W3, "long"),
        _whole("evt_cnt", "count(*)", "today"), _whole("evt_cnt", "count(*)", "yesterday"),
        _grouped("type_cnt", "event_type", {"10m": 10 * MIN, "3h": 3 * HOUR}),
        _whole_grouped("today"), _whole_grouped("yesterday"),
        _numeric("val_sum", "CAST(v AS DECIMAL(18,2))", "sum", W3, "double"),
        _numeric("k_sum", "k", "sum", W3, "long"),
        _whole("k_sum", "sum(k)", "today"), _whole("k_sum", "sum(k)", "yesterday"),
        _numeric("val_max", "v", "max", W3, "double"),
        _numeric("val_min", "v", "min", W3, "double"),
        _numeric("k_max", "k", "max", {"3h": 3 * HOUR, "60m": HOUR, "1h": HOUR}, "long"),
        _numeric("k_min", "k", "min", {"3h": 3 * HOUR}, "long"),
        _items("recent_k", {"3h": 3 * HOUR, "24h": DAY}, 5, False, False, "CAST(k AS VARCHAR)"),
        _items("recent_k_ts", {"24h": DAY}, 3, True, False, "CAST(k AS VARCHAR)"),
        _items("recent_type", {"24h": DAY}, 3, False, True, "event_type"),
        _items("recent_type_ts", {"3h": 3 * HOUR}, 2, True, True, "event_type"),
        _numeric("tgt_buy_cnt", "", "count", {"24h": DAY}, "long", filt="event_type = 'purchase'",
                 id_expr="CAST(k AS VARCHAR)"),
        _numeric("anchor_cnt", "", "count", {"10m": 10 * MIN, "3h": 3 * HOUR}, "long",
                 filt="event_type <> 'purchase'", id_expr="CAST(anchor AS VARCHAR)"),
    ]


# the other cadences: one-hour and one-second panes
_OTHER_CADENCES = [
    _numeric("evt_cnt_hourly", "", "count", {"3h": 3 * HOUR, "24h": DAY}, "long", pane=HOUR),
    _numeric("evt_cnt_sliding", "", "count", {"5m": 5 * MIN}, "long", pane=1000),
]


_LATEST_CTE = f"""lt AS (SELECT uid AS id, {_pane('event_ms')} AS pe, event_type,
             row_number() OVER (PARTITION BY uid, {_pane('event_ms')} ORDER BY event_ms DESC, event_type DESC) AS rn
      FROM ev)"""


_ATOMS = _union(
    f"SELECT 'uid' AS id_type, {_out(id_expr='uid', name=repr('evt_value'), ts='event_ms', vt='CAST(v AS VARCHAR)')} FROM ev",
    f"SELECT 'uid', {_out(id_expr='uid', name=repr('evt_type'), ts='event_ms', vt='event_type')} FROM ev",
    f"SELECT 'uid', {_out(id_expr='uid', name=repr('evt_k10'), ts='event_ms', vt='CAST(k * 10 AS VARCHAR)')} FROM ev",
)


def _all_features_sql() -> str:
    minute = _all_parts()
    parts = minute + _OTHER_CADENCES
    id_types = ["uid"] * (len(minute) - 2) + ["targetUid", "anchorUid"] + ["uid"] * len(_OTHER_CADENCES)
    selects = [f"SELECT '{t}' AS id_type, * FROM ({s})" for (_, s), t in zip(parts, id_types)]
    selects.append(f"SELECT 'uid' AS id_type, {_out(name=repr('last_type'), ts='pe', vt='event_type')} FROM lt WHERE rn = 1")
    body = _union(*selects, _ATOMS)
    return (_with(EV, *[c for c, _ in parts], _LATEST_CTE) +
            "SELECT id, id_type, feature_name, ts, value_long, round(value_double, 2) AS value_double, value_text FROM (\n"
            + body + "\n) u")


ALL_FEATURES = _all_features_sql()


# --------------------------------------------------------------------------- sinks
def _cells_sql() -> str:
    parts = [
        _numeric("evt_cnt", "", "count", W3, "long"),
        _whole("evt_cnt", "count(*)", "today"),
        _numeric("k_sum", "k", "sum", {"24h": DAY}, "long"),
        _items("recent_type", {"24h": DAY}, 3, False, True, "event_type"),
    ]
    feats = _union(
        *[s for _, s in parts],
        f"SELECT {_out(name=repr('last_type'), ts='pe', vt='event_type')} FROM lt WHERE rn = 1",
        f"SELECT {_out(id_expr='uid', name=repr('evt_type'), ts='event_ms', vt='event_type')} FROM ev",
    )
    mapping = """(VALUES
      ('evt_cnt_10m', 'user_feature', 'cnt_10m', 86400000, 'social'),
      ('evt_cnt_3h', 'user_feature', 'evt_cnt_3h', 86400000, 'social'),
      ('evt_cnt_today', 'user_feature', 'cnt_today', 86400000, 'social'),
      ('k_sum_24h', 'user_feature', 'k_24h', 86400000, NULL),
      ('recent_type_24h', 'user_feature', 'recent_types', 86400000, 'social'),
      ('last_type', 'user_feature', 'last_type', 86400000, 'social'),
      ('evt_type', 'user_atom', 'type', NULL, 'social')) m(feature_name, tbl, col, ttl_ms, biz_type)"""
    return (_with(EV, *[c for c, _ in parts], _LATEST_CTE) + f""",
feats AS ({feats}),
cells AS (
  SELECT m.tbl AS "table", right(f.id, 1) || f.id AS row_key, m.col AS "column", f.ts,
         COALESCE(CAST(f.value_long AS VARCHAR), f.value_text) AS value, CAST(m.ttl_ms AS BIGINT) AS ttl_ms,
         f.id, 'uid' AS id_type, m.biz_type
  FROM feats f JOIN {mapping} USING (feature_name)
)
""")


SERVING_CELLS = _cells_sql() + 'SELECT "table", row_key, "column", ts, value, ttl_ms FROM cells'

CELL_SNAPSHOT = _cells_sql() + """
SELECT "table", row_key, "column", max(ts) AS ts, arg_max(value, (ts, value)) AS value,
       max(ts) + max(ttl_ms) AS expires_at_ms,
       'ts:' || CAST(max(ts) AS VARCHAR) || ',' || arg_max(value, (ts, value)) AS cache_text
FROM cells GROUP BY ALL"""

# cells that have not expired when the newest event happens
CELL_SNAPSHOT_LIVE = (f"SELECT * FROM ({CELL_SNAPSHOT}) s WHERE expires_at_ms IS NULL OR "
                      "expires_at_ms > (SELECT max(epoch_us(ts) // 1000) FROM events)")

FEATURE_MESSAGES = _cells_sql() + """,
dedup AS (SELECT id, id_type, biz_type, ts, "column", max(value) AS value FROM cells
          WHERE biz_type IS NOT NULL GROUP BY ALL)
SELECT id, id_type, biz_type, ts, CAST(count(*) OVER (PARTITION BY id, id_type, biz_type, ts) AS INTEGER) AS n_columns,
       "column", value
FROM dedup"""

# two rows of an entity, or a second, make a batch
MESSAGE_BATCHES = _cells_sql() + """,
placed AS (SELECT *, ts // 1000 AS sec, (row_number() OVER (PARTITION BY id, id_type, ts // 1000 ORDER BY ts, "column", value) - 1) // 2 AS batch FROM cells),
per_column AS (SELECT id, id_type, biz_type, sec, batch, "column", arg_max(value, (ts, value)) AS value, max(ts) AS last FROM placed
               WHERE biz_type IS NOT NULL GROUP BY ALL)
SELECT id, id_type, biz_type, max(last) OVER w AS ts, batch, CAST(count(*) OVER w AS INTEGER) AS n_columns, "column", value
FROM per_column WINDOW w AS (PARTITION BY id, id_type, biz_type, sec, batch)"""

OUTPUT_COUNTS = _cells_sql() + 'SELECT "column", count(*) AS n FROM cells GROUP BY ALL'


# --------------------------------------------------------------------------- streaming (closed panes only)
_STREAM_DELAY = MIN


def _closed(sql_body: str, ts_col: str) -> str:
    return f"SELECT * FROM ({sql_body}) q WHERE {ts_col} <= (SELECT max(event_ms) FROM ev) - {_STREAM_DELAY}"


STREAM_PANES = _with(EV) + _closed(_union(
    f"SELECT uid AS id, 'uid' AS id_type, 'evt_cnt' AS feature, '' AS sub_key, {_pane('event_ms')} AS pane_end_ms, "
    "count(*) AS cnt, CAST(NULL AS BIGINT) AS num_long FROM ev GROUP BY ALL",
    f"SELECT uid, 'uid', 'type_cnt', event_type, {_pane('event_ms')}, count(*), CAST(NULL AS BIGINT) FROM ev GROUP BY ALL",
    f"SELECT uid, 'uid', 'k_sum', '', {_pane('event_ms')}, count(*), CAST(sum(k) AS BIGINT) FROM ev GROUP BY ALL",
), "pane_end_ms")


def _stream_features() -> str:
    parts = [
        _numeric("evt_cnt", "", "count", W3, "long"),
        _whole("evt_cnt", "count(*)", "today"), _whole("evt_cnt", "count(*)", "yesterday"),
        _grouped("type_cnt", "event_type", {"10m": 10 * MIN, "3h": 3 * HOUR}),
        _whole_grouped("today"), _whole_grouped("yesterday"),
        _numeric("k_sum", "k", "sum", W3, "long"),
        _whole("k_sum", "sum(k)", "today"), _whole("k_sum", "sum(k)", "yesterday"),
    ]
    body = _union(*[s for _, s in parts])
    return _with(EV, *[c for c, _ in parts]) + _closed(
        f"SELECT id, feature_name, ts, value_long FROM ({body}) u", "ts")


STREAM_FEATURES = _stream_features()


def _stream_recent() -> str:
    parts = [
        _items("recent_k", {"3h": 3 * HOUR, "24h": DAY}, 5, False, False, "CAST(k AS VARCHAR)"),
        _items("recent_type", {"24h": DAY}, 3, False, True, "event_type"),
    ]
    body = _union(*[s for _, s in parts],
                  f"SELECT {_out(name=repr('last_type'), ts='pe', vt='event_type')} FROM lt WHERE rn = 1")
    return _with(EV, *[c for c, _ in parts], _LATEST_CTE) + _closed(
        f"SELECT id, feature_name, ts, value_text FROM ({body}) u", "ts")


STREAM_RECENT = _stream_recent()


def _stream_all() -> str:
    """Every feature of a closed pane of any cadence, and every atom."""
    minute = _all_parts()
    parts = minute + _OTHER_CADENCES
    id_types = ["uid"] * (len(minute) - 2) + ["targetUid", "anchorUid"] + ["uid"] * len(_OTHER_CADENCES)
    windowed = _union(*[f"SELECT '{t}' AS id_type, * FROM ({s})" for (_, s), t in zip(parts, id_types)],
                      f"SELECT 'uid' AS id_type, {_out(name=repr('last_type'), ts='pe', vt='event_type')} FROM lt WHERE rn = 1")
    columns = "id, id_type, feature_name, ts, value_long, round(value_double, 2) AS value_double, value_text"
    return (_with(EV, *[c for c, _ in parts], _LATEST_CTE)
            + _closed(f"SELECT {columns} FROM ({windowed}) u", "ts")
            + f" UNION ALL SELECT {columns} FROM ({_ATOMS}) v")


STREAM_ALL_FEATURES = _stream_all()


# panes inside their retention as of the last watermark
_LAST_MARK = f"(SELECT max(event_ms) - {_STREAM_DELAY} FROM ev)"
STREAM_RETENTION = _with(EV, "p AS (" + _union(
    f"SELECT uid AS id, 'uid' AS id_type, 'evt_cnt' AS feature, '' AS sub_key, {_pane('event_ms')} AS pane_end_ms, "
    f"count(*) AS cnt, CAST(NULL AS BIGINT) AS num_long, {2 * DAY} AS keep FROM ev GROUP BY ALL",
    f"SELECT uid, 'uid', 'type_cnt', event_type, {_pane('event_ms')}, count(*), NULL, {2 * DAY} FROM ev GROUP BY ALL",
    f"SELECT uid, 'uid', 'k_sum', '', {_pane('event_ms')}, count(*), CAST(sum(k) AS BIGINT), {2 * DAY} FROM ev GROUP BY ALL",
    f"SELECT uid, 'uid', 'recent_k', '', pe, least(count(*), 5), NULL, {DAY} FROM "
    f"(SELECT DISTINCT uid, {_pane('event_ms')} AS pe, k, event_ms FROM ev) GROUP BY uid, pe") + ")") + f"""
SELECT id, id_type, feature, sub_key, pane_end_ms, cnt, num_long FROM p
WHERE pane_end_ms <= {_LAST_MARK} AND pane_end_ms > {_LAST_MARK} - keep"""

# the stream comes in four quarters of the time range
_QUARTERS = """
span AS (SELECT min(event_ms) AS lo, greatest(1, (max(event_ms) - min(event_ms)) // 4 + 1) AS width FROM ev),
quarter AS (SELECT ev.*, (event_ms - lo) // width AS q FROM ev, span)"""

# every seventh event comes a quarter late; it is late if its pane was closed by then
STREAM_LATE_ROWS = _with(EV, _QUARTERS, f"""
came AS (SELECT *, least(q + CASE WHEN anchor = 0 THEN 1 ELSE 0 END, 3) AS came FROM quarter),
marks AS (SELECT c.n, (SELECT max(event_ms) - {_STREAM_DELAY} FROM came WHERE came <= c.n) AS mark FROM (VALUES (0), (1), (2)) c(n)),
behind AS (SELECT count(*) AS n FROM came JOIN marks ON marks.n = came.came - 1 WHERE {_pane('event_ms')} <= mark)""",
    *[c for c, _ in (_numeric("evt_cnt", "", "count", W3, "long"), _whole("evt_cnt", "count(*)", "today"),
                     _whole("evt_cnt", "count(*)", "yesterday"), _numeric("k_sum", "k", "sum", W3, "long"),
                     _whole("k_sum", "sum(k)", "today"), _whole("k_sum", "sum(k)", "yesterday"))]) + _closed(
    "SELECT id, feature_name, ts, value_long, behind.n AS late_events, behind.n AS applied_events FROM (" + _union(
        *[s for _, s in (_numeric("evt_cnt", "", "count", W3, "long"), _whole("evt_cnt", "count(*)", "today"),
                         _whole("evt_cnt", "count(*)", "yesterday"), _numeric("k_sum", "k", "sum", W3, "long"),
                         _whole("k_sum", "sum(k)", "today"), _whole("k_sum", "sum(k)", "yesterday"))]) + ") u, behind", "ts")

# specs 1 and 4 in the first half of the stream, 1 and 7 in the second
_CHANGED = [_numeric("evt_cnt", "", "count", W3, "long"), _whole("evt_cnt", "count(*)", "today"), _whole("evt_cnt", "count(*)", "yesterday"),
            _numeric("k_max", "k", "max", {"3h": 3 * HOUR, "60m": HOUR, "1h": HOUR}, "long", src="second_half")]
_DELETED = [_numeric("k_sum", "k", "sum", W3, "long"), _whole("k_sum", "sum(k)", "today"), _whole("k_sum", "sum(k)", "yesterday")]
STREAM_SPEC_CHANGE = _with(EV, _QUARTERS, "second_half AS (SELECT * FROM quarter WHERE q >= 2)",
                           *[c for c, _ in _CHANGED + _DELETED]) + (
    _closed("SELECT id, feature_name, ts, value_long FROM (" + _union(*[s for _, s in _CHANGED]) + ") u", "ts")
    + " UNION ALL SELECT id, feature_name, ts, value_long FROM (" + _union(*[s for _, s in _DELETED])
    + f") d WHERE ts <= (SELECT max(event_ms) - {_STREAM_DELAY} FROM quarter WHERE q < 2)")


# cells of closed panes and of atoms (which wait for no pane)
_STREAM_CELLS = _cells_sql() + f""",
closed AS (SELECT * FROM cells WHERE "column" = 'type' OR ts <= (SELECT max(event_ms) FROM ev) - {_STREAM_DELAY})
"""
STREAM_CELLS = _STREAM_CELLS + 'SELECT "table", row_key, "column", ts, value, ttl_ms FROM closed'
# windowed and atom cells come from two queries, so each has messages of its own
STREAM_MESSAGES = _STREAM_CELLS + """,
dedup AS (SELECT id, id_type, biz_type, ts, "column" = 'type' AS atom, "column", max(value) AS value FROM closed
          WHERE biz_type IS NOT NULL GROUP BY ALL)
SELECT id, id_type, biz_type, ts, CAST(count(*) OVER (PARTITION BY id, id_type, biz_type, ts, atom) AS INTEGER) AS n_columns,
       "column", value
FROM dedup"""

STREAM_MESSAGE_BATCHES = _STREAM_CELLS + """,
placed AS (SELECT *, "column" = 'type' AS atom, ts // 1000 AS sec,
                  (row_number() OVER (PARTITION BY id, id_type, "column" = 'type', ts // 1000 ORDER BY ts, "column", value) - 1) // 2 AS batch FROM closed),
per_column AS (SELECT id, id_type, biz_type, atom, sec, batch, "column", arg_max(value, (ts, value)) AS value, max(ts) AS last FROM placed
               WHERE biz_type IS NOT NULL GROUP BY ALL)
SELECT id, id_type, biz_type, max(last) OVER w AS ts, batch, CAST(count(*) OVER w AS INTEGER) AS n_columns, "column", value
FROM per_column WINDOW w AS (PARTITION BY id, id_type, biz_type, atom, sec, batch)"""


ORACLES = {
    "parse_events": PARSE_EVENTS,
    "dim_fanout": DIM_FANOUT,
    "route_match": ROUTE_MATCH,
    "atom_features": ATOM_FEATURES,
    "spec_validation": SPEC_VALIDATION,
    "pane_count": PANE_COUNT,
    "pane_count_grouped": PANE_COUNT_GROUPED,
    "rel_count": REL_COUNT,
    "rel_count_grouped": REL_COUNT_GROUPED,
    "rel_sum_long": REL_SUM_LONG,
    "rel_sum_double": REL_SUM_DOUBLE,
    "rel_max": REL_MAX,
    "rel_min": REL_MIN,
    "recent_list": RECENT_LIST,
    "recent_list_ts": RECENT_LIST_TS,
    "recent_set": RECENT_SET,
    "recent_set_ts": RECENT_SET_TS,
    "recent_set_custom_time": RECENT_SET_CUSTOM_TIME,
    "rel_sum_huge": REL_SUM_HUGE,
    "prefixed_ids": PREFIXED_IDS,
    "cell_snapshot_live": CELL_SNAPSHOT_LIVE,
    "latest_value": LATEST_VALUE,
    "whole_today": WHOLE_TODAY,
    "whole_yesterday": WHOLE_YESTERDAY,
    "hourly_cadence": HOURLY_CADENCE,
    "second_cadence": SECOND_CADENCE,
    "target_dims": TARGET_DIMS,
    "session_partials": SESSION_PARTIALS,
    "retention_panes": RETENTION_PANES,
    "all_features": ALL_FEATURES,
    "serving_cells": SERVING_CELLS,
    "cell_snapshot": CELL_SNAPSHOT,
    "snapshot_incremental": CELL_SNAPSHOT,
    "feature_messages": FEATURE_MESSAGES,
    "message_batches": MESSAGE_BATCHES,
    "output_counts": OUTPUT_COUNTS,
    "orders_spend_windows": ORDERS_SPEND_WINDOWS,
    "lineitem_part_demand": LINEITEM_PART_DEMAND,
    "stream_panes": STREAM_PANES,
    "stream_features": STREAM_FEATURES,
    "stream_recent": STREAM_RECENT,
    "stream_all_features": STREAM_ALL_FEATURES,
    "stream_retention": STREAM_RETENTION,
    "stream_late_rows": STREAM_LATE_ROWS,
    "stream_spec_change": STREAM_SPEC_CHANGE,
    "stream_cells": STREAM_CELLS,
    "stream_messages": STREAM_MESSAGES,
    "stream_message_batches": STREAM_MESSAGE_BATCHES,
}
