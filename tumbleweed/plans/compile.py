"""Spec compiler: spec rows -> routing, window and sink tables.

A spec set is configuration -- like the text of a query -- so it is read once
and compiled on the driver.  The outputs are small tables
(one row per spec x route, spec x window, feature x sink column) whose size
is bounded by the spec set, never by the events; they enter the data plans
as literal broadcast tables.  Distinct non-plain field expressions become
``F.expr`` branches and distinct look-back lengths become RANGE frame bounds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tumbleweed.functions.fields import compile_expressions
from tumbleweed.functions.intervals import WHOLE_WINDOWS
from tumbleweed.plans.kinds import added_kind
from tumbleweed.sources.events import DEFAULT_EVENT_TIME_FIELD

# Feature kinds of the spec format (configType, case-insensitive).
WINDOWED_KINDS = ("count", "sum", "max", "min", "list", "set", "latest")
KINDS = WINDOWED_KINDS + ("atom",)
NUMERIC_TYPES = ("long", "double")
WHOLE_WINDOW_TYPE = "wholeWindow"
CELL_SINK_TYPES = ("hbase", "cells")


@dataclass
class CompiledSpecs:
    """Compiled spec tables.

    Each table is held twice: as driver-side rows (configuration, bounded by
    the spec count) for planning decisions, and as a literal in-plan
    DataFrame for joins.  Planning therefore runs no Spark job.
    """

    specs: DataFrame          # one row per valid spec, normalised columns
    validation: DataFrame     # (spec_id, feature, error) for rejected specs
    routes: DataFrame         # (spec_id, biz_type, event_type, target_type, id_type, cadence_ms)
    windows: DataFrame        # (spec_id, feature, window, window_ms, whole, cadence_ms)
    atom_fields: DataFrame    # (spec_id, feature, source_field, out_name)
    sink_fields: DataFrame    # (feature_name, sink_type, table, ttl_ms, column, biz_type)
    expressions: dict[str, str] = field(default_factory=dict)
    rows: dict[str, list] = field(default_factory=dict)

    def _kind_of(self) -> dict:
        return {r.spec_id: r for r in self.rows["specs"]}

    def _relative(self, kinds, cadence_ms):
        specs = self._kind_of()
        return [(w, specs[w.spec_id]) for w in self.rows["windows"]
                if w.whole is None and w.cadence_ms == cadence_ms and specs[w.spec_id].kind in kinds]

    def list_frames(self, cadence_ms: int, clock_field: str) -> list[tuple[int, int, bool]]:
        """(window_ms, largest capacity, items follow the pane clock) of LIST specs."""
        acc: dict[int, tuple[int, bool]] = {}
        for w, spec in self._relative(("list",), cadence_ms):
            k, aligned = acc.get(w.window_ms, (0, True))
            acc[w.window_ms] = (max(k, spec.capacity), aligned and spec.time_field == clock_field)
        return sorted((ms, k, a) for ms, (k, a) in acc.items())

    def cadences(self) -> list[int]:
        """Pane lengths that some windowed spec is routed at."""
        return sorted({r.cadence_ms for r in self.rows["routes"] if r.cadence_ms is not None})

    def kinds_at(self, *cadences: int) -> set[str]:
        """Kinds with at least one route at these cadences."""
        specs = self._kind_of()
        return {specs[r.spec_id].kind for r in self.rows["routes"] if r.cadence_ms in cadences}

    def max_capacity(self) -> int | None:
        caps = [r.capacity for r in self.rows["specs"] if r.kind in ("list", "set") and r.capacity]
        return max(caps) if caps else None

    def restrict_windows(self, names) -> "CompiledSpecs":
        """A copy whose roll-ups compute only the named windows.

        Feature-level pruning: frames for windows nobody reads are never
        planned.  Routing (and so the pane table) is unchanged.
        """
        import dataclasses

        keep = [w for w in self.rows["windows"] if w.window in set(names)]
        rows = dict(self.rows, windows=keep)
        table = literal_table(self.specs.sparkSession, [tuple(w) for w in keep], WINDOW_COLUMNS)
        return dataclasses.replace(self, windows=table, rows=rows)

    def restrict_features(self, names) -> "CompiledSpecs":
        """A copy that computes only the features named (e.g. those a sink persists).

        A window survives when some spec's ``<prefix>_<window>`` (or, for a
        grouped COUNT, ``<prefix>_<group>_<window>``) is named; atom fields by
        their output name; LATEST by its bare prefix.  Specs left with nothing
        to compute lose their routes, so their events never reach the pane
        build.
        """
        import dataclasses

        names = set(names)
        specs = {r.spec_id: r for r in self.rows["specs"]}

        def wanted(w) -> bool:
            sp = specs[w.spec_id]
            if sp.kind == "latest":
                return sp.feature in names
            if sp.kind == "count" and sp.group_by is not None:
                return any(n.startswith(sp.feature + "_") and n.endswith("_" + w.window) for n in names)
            return f"{sp.feature}_{w.window}" in names

        windows = [w for w in self.rows["windows"] if wanted(w)]
        atoms = [a for a in self.rows["atom_fields"] if a.out_name in names]
        live = {w.spec_id for w in windows} | {a.spec_id for a in atoms}
        # LATEST needs a window only for its cadence; keep one when it is named
        routes = [r for r in self.rows["routes"] if r.spec_id in live
                  and (r.cadence_ms is None or any(w.spec_id == r.spec_id and w.cadence_ms == r.cadence_ms
                                                    for w in windows))]
        rows = dict(self.rows, windows=windows, atom_fields=atoms, routes=routes)
        spark = self.specs.sparkSession
        return dataclasses.replace(
            self, rows=rows,
            windows=literal_table(spark, [tuple(w) for w in windows], WINDOW_COLUMNS),
            atom_fields=literal_table(spark, [tuple(a) for a in atoms], ATOM_COLUMNS),
            routes=literal_table(spark, [tuple(r) for r in routes], ROUTE_COLUMNS))

    def base_cadence(self) -> int | None:
        """The pane length that every cadence is made of; None without windowed specs."""
        import math

        return math.gcd(*self.cadences()) if self.cadences() else None

    def id_types(self) -> set[str]:
        """The id types some spec is routed by."""
        return {r.id_type for r in self.rows["routes"]}

    def feature_cadences(self) -> tuple[DataFrame, int]:
        """``(feature, id_type, cadence_ms)`` of the windowed specs, and the number of rows."""
        specs = self._kind_of()
        rows = sorted({(specs[r.spec_id].feature, r.id_type, r.cadence_ms) for r in self.rows["routes"] if r.cadence_ms is not None})
        return literal_table(self.specs.sparkSession, rows, "feature string, id_type string, cadence_ms bigint"), len(rows)

    def route_table(self, cadences: list[int], as_cadence: int | None = None) -> DataFrame:
        """Routes of these cadences joined with their spec parameters (windowed kinds).

        With ``as_cadence`` each spec and route is there once, at that cadence.
        """
        specs = self._kind_of()
        out = set()
        for r in self.rows["routes"]:
            if r.cadence_ms in cadences and specs[r.spec_id].kind != "atom":
                sp = specs[r.spec_id]
                out.add((r.biz_type, r.event_type, r.target_type, r.id_type, as_cadence or r.cadence_ms, sp.spec_id, sp.kind,
                         sp.feature, sp.field, sp.field_type, sp.group_by, sp.time_field, sp.capacity))
        schema = ("biz_type string, event_type string, target_type string, id_type string, cadence_ms bigint, "
                  "spec_id int, kind string, feature string, field string, field_type string, group_by string, "
                  "time_field string, capacity int")
        return literal_table(self.specs.sparkSession, sorted(out, key=repr), schema)


def _is_blank(v) -> bool:
    return v is None or str(v).strip() == ""


def _parse_interval(text):
    from tumbleweed.functions.intervals import parse_interval_ms

    return parse_interval_ms(text)


SPEC_COLUMNS = ("spec_id int, kind string, feature string, id_type string, field string, field_type string, "
                "group_by string, time_field string, capacity int, need_ts boolean, spec_biz_type string")
VALIDATION_COLUMNS = "spec_id int, feature string, error string"
ROUTE_COLUMNS = ("spec_id int, biz_type string, event_type string, target_type string, id_type string, "
                 "cadence_ms bigint")
WINDOW_COLUMNS = "spec_id int, feature string, window string, window_ms bigint, whole string, cadence_ms bigint"
ATOM_COLUMNS = "spec_id int, feature string, source_field string, out_name string"
SINK_COLUMNS = ("feature_name string, sink_type string, table string, ttl_ms bigint, column string, "
                "biz_type string")


def _spec_error(sp: dict) -> str | None:
    """First failed per-spec rule, or None."""
    kind = sp["kind"]
    if sp["spec_id"] is None:
        return "missing id"
    if kind not in KINDS and added_kind(kind) is None:
        return f"unknown kind: {kind if kind is not None else 'null'}"
    if _is_blank(sp["feature"]):
        return "blank featureNamePrefix"
    if _is_blank(sp["id_type"]):
        return "blank idType"
    if not sp["type_config"]:
        return "empty typeConfig"
    if kind in ("sum", "max", "min", "list", "set", "latest") and _is_blank(sp["field"]):
        return "missing aggConfig.field"
    if kind in ("sum", "max", "min") and sp["field_type"] not in NUMERIC_TYPES:
        return f"bad fieldType: {sp['field_type'] if sp['field_type'] is not None else 'null'}"
    if kind in ("list", "set") and not (sp["capacity"] or 0) >= 1:
        return "capacity must be >= 1"
    if kind == "atom" and not sp["atom_fields"]:
        return "atom spec without aggConfig.fields"
    if kind not in ("atom", "latest") and not sp["windows"]:
        return "no windows"
    return added_kind(kind).validate(sp) if kind not in KINDS else None


def _window_errors(sp: dict) -> list[str]:
    """Per-window rules (D10, D12); LATEST only uses its windows for the cadence."""
    if sp["kind"] in ("atom", "latest") or (sp["kind"] not in KINDS and added_kind(sp["kind"]) is None):
        return []
    out = []
    for w in sp["windows"]:
        if w["window"] is None:
            continue
        if w["cadence_ms"] is None:
            out.append(f"bad delay: {w['delay'] if w['delay'] is not None else 'null'}")
        elif w["is_whole"] and w["window"] not in WHOLE_WINDOWS:
            out.append(f"unknown whole window: {w['window']}")
        elif not w["is_whole"] and w["window_ms"] is None:
            out.append(f"bad window: {w['window']}")
    return out


def _normalise(r) -> dict:
    agg = r["aggConfig"]
    get = (lambda k: agg[k] if agg is not None else None)
    kind = r["configType"].strip().lower() if r["configType"] is not None else None
    windows = []
    for w in r["windows"] or []:
        is_whole = w["windowType"] == WHOLE_WINDOW_TYPE
        windows.append({
            "window": w["window"], "delay": w["delay"], "is_whole": is_whole,
            "window_ms": _parse_interval(w["window"]), "cadence_ms": _parse_interval(w["delay"]),
        })
    return {
        "spec_id": r["id"], "kind": kind, "spec_biz_type": r["bizType"] or "",
        "id_type": r["idType"], "feature": r["featureNamePrefix"],
        "type_config": list(r["typeConfig"] or []),
        "field": get("field"), "field_type": get("fieldType"), "group_by": get("groupByField"),
        "time_field": get("eventTimeField") or DEFAULT_EVENT_TIME_FIELD,
        "capacity": get("capacity"), "need_ts": bool(get("needTs")) if get("needTs") is not None else False,
        "atom_fields": list(get("fields") or []), "windows": windows, "sinks": list(r["sinks"] or []),
    }


def compile_specs(specs: DataFrame) -> CompiledSpecs:
    """Validate and compile a spec set.

    The spec set is configuration, so it is read once and compiled on the
    driver, like a query text; the tables it yields are carried into the data
    plans, and their rows are counted, which decides whether they may be
    broadcast.
    """
    spark = specs.sparkSession
    parsed = [_normalise(r) for r in specs.collect()]

    def texts_of(sp: dict) -> list[str]:
        return [t for t in (sp["field"], sp["group_by"], sp["time_field"], *(f["sourceField"] for f in sp["atom_fields"]))
                if not _is_blank(t)]

    expressions, unresolved = compile_expressions(spark, {t for sp in parsed for t in texts_of(sp)})

    validation, valid = [], []
    owner: dict[tuple, int] = {}
    ids: set[int] = set()
    for sp in sorted(parsed, key=lambda x: (x["spec_id"] is None, x["spec_id"] or 0)):
        errs = [f"bad expression: {t}" for t in texts_of(sp) if t in unresolved]
        err = _spec_error(sp)
        if err is not None:
            errs.append(err)
        errs += _window_errors(sp)
        # D3: one spec per (prefix, id type) -- the lowest id among the valid ones keeps it
        if not errs and owner.setdefault((sp["feature"], sp["id_type"]), sp["spec_id"]) != sp["spec_id"]:
            errs.append("duplicate featureNamePrefix for idType")
        if not errs and sp["spec_id"] in ids:
            errs.append("duplicate id")
        if errs:
            validation.append((sp["spec_id"], sp["feature"], "; ".join(sorted(set(errs)))))
        else:
            ids.add(sp["spec_id"])
            valid.append(sp)

    spec_rows, window_rows, route_rows, atom_rows, sink_rows = [], set(), set(), [], {}
    for sp in valid:
        sid, kind = sp["spec_id"], sp["kind"]
        spec_rows.append((sid, kind, sp["feature"], sp["id_type"], sp["field"], sp["field_type"], sp["group_by"],
                          sp["time_field"], sp["capacity"], sp["need_ts"], sp["spec_biz_type"]))
        cadences = set()
        if kind != "atom":
            for w in sp["windows"]:
                if w["window"] is None:
                    continue
                whole = w["window"] if w["is_whole"] else None
                window_rows.add((sid, sp["feature"], w["window"], None if whole else w["window_ms"], whole,
                                 w["cadence_ms"]))
                cadences.add(w["cadence_ms"])
        for t in sp["type_config"]:
            # Absent route parts are '' on both sides
            key = tuple("" if t[k] is None else t[k] for k in ("bizType", "eventType", "targetType"))
            # One route per (spec, route key, cadence)
            for cadence in (cadences if kind != "atom" else {None}):
                route_rows.add((sid, *key, sp["id_type"], cadence))
        if kind == "atom":
            for f in sp["atom_fields"]:
                if not _is_blank(f["sourceField"]):
                    name = "_".join(x for x in (sp["feature"], f["featureName"]) if x is not None)
                    atom_rows.append((sid, sp["feature"], f["sourceField"], name))
        for sink in sp["sinks"]:
            sink_type = sink["type"].lower() if sink["type"] is not None else None
            if sink_type not in CELL_SINK_TYPES:  # O5: the spec runs, this sink takes nothing
                validation.append((sid, sp["feature"], f"no writer for sink type: {sink_type if sink_type is not None else 'null'}"))
            for feature_name, m in (sink["fields"] or {}).items():
                ttl = m["ttl"]
                row = (feature_name, sink_type, m["table"], ttl * 1000 if ttl is not None and ttl > 0 else None,
                       # A blank rename falls back to the feature name
                       feature_name if _is_blank(m["rename"]) else m["rename"],
                       None if _is_blank(sp["spec_biz_type"]) else sp["spec_biz_type"])
                prev = sink_rows.get((sink_type, feature_name))
                if prev is None or prev[0] < sid:   # the newest spec owns a sink column
                    sink_rows[(sink_type, feature_name)] = (sid, row)

    rows = {
        "specs": spec_rows, "validation": validation, "routes": sorted(route_rows, key=repr),
        "windows": sorted(window_rows, key=repr), "atom_fields": atom_rows,
        "sink_fields": [row for _, row in sink_rows.values()],
    }
    schemas = {"specs": SPEC_COLUMNS, "validation": VALIDATION_COLUMNS, "routes": ROUTE_COLUMNS,
               "windows": WINDOW_COLUMNS, "atom_fields": ATOM_COLUMNS, "sink_fields": SINK_COLUMNS}
    from pyspark.sql import Row
    from pyspark.sql.types import StructType

    named = {}
    for name, schema in schemas.items():
        fields = StructType.fromDDL(schema).fieldNames()
        named[name] = [Row(**dict(zip(fields, r))) for r in rows[name]]
    frames = {name: literal_table(spark, rows[name], schemas[name]) for name in schemas}

    return CompiledSpecs(**frames, expressions=expressions, rows=named)


#: Spec-derived tables up to this many rows are broadcast; past it the planner chooses by size.
BROADCAST_ROWS = 100_000


def spec_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its ``rows`` (counted when it was compiled) allow it."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def unbroadcast(df: DataFrame) -> DataFrame:
    """``df`` as a side of a sort-merge join: for sides that grow with the data.

    The planner sizes a side by its files, and pane tables are small as files (long runs of
    equal values) and many times that as rows, all of which a broadcast puts on the driver.
    """
    return df.hint("merge")


def literal_table(spark, rows: list, schema, names: list[str] | None = None) -> DataFrame:
    """A table carried inside the plan as one JSON literal: no job, and one call whatever its size."""
    import json

    from pyspark.sql.types import StructType

    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    names = names or schema.fieldNames()

    def plain(value, dtype):
        if value is None:
            return None
        if hasattr(dtype, "elementType"):
            return [plain(v, dtype.elementType) for v in value]
        if hasattr(dtype, "fields"):
            return {f.name: plain(v, f.dataType) for v, f in zip(tuple(value), dtype.fields)}
        return value

    text = json.dumps([plain(tuple(r), schema) for r in rows])
    parsed = F.from_json(F.lit(text), f"array<{schema.simpleString()}>")
    return spark.range(1).select(F.inline(parsed)).select(*names)
