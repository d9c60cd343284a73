"""Pane build: level-1 partials per (entity, feature, sub key, pane).

All specs of all kinds share one pane table with a fixed schema, so a spec
change never changes the state schema (T6):

    id, id_type, feature, kind, sub_key, cadence_ms, pane_end_ms,
    cnt, num_long, num_double, items array<struct<ts,value>>, latest_value, latest_ms, state

* numeric kinds and LATEST: one ``groupBy`` with built-in aggregates, planned
  as partial + final HashAggregate, so a hot entity is pre-aggregated on the
  map side and ships at most one partial per task and pane;
* LIST / SET: duplicates are folded by a map-side-combined ``groupBy`` first,
  then the newest ``capacity`` items per pane are kept with ``row_number``;
  Spark's WindowGroupLimit applies the limit before the shuffle, so no pane
  ever gathers more than capacity x tasks items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tumbleweed.functions.scalars import pane_end_ms
from tumbleweed.plans.kinds import FeatureKind, added_kinds

PANE_KEYS = ["id", "id_type", "feature", "kind", "sub_key", "cadence_ms", "pane_end_ms"]
PANE_COLUMNS = PANE_KEYS + ["cnt", "num_long", "num_double", "items", "latest_value", "latest_ms", "state"]
ITEM_TYPE = "array<struct<ts:bigint,value:string>>"
PANE_SCHEMA = ("id string, id_type string, feature string, kind string, sub_key string, cadence_ms bigint, "
               f"pane_end_ms bigint, cnt bigint, num_long bigint, num_double double, items {ITEM_TYPE}, "
               "latest_value string, latest_ms bigint, state binary")

#: Partials as :func:`pane_partials` makes them (the stream keeps them in a table).
PARTIAL_SCHEMA = ("id string, id_type string, feature string, kind string, sub_key string, cadence_ms bigint, "
                  "pane_end_ms bigint, _v string, _t bigint, cnt bigint, _sum_l bigint, _max_l bigint, _min_l bigint, "
                  "_sum_d double, _max_d double, _min_d double, item_ms bigint, capacity int, state binary")


def contributing(routed: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Apply the per-kind null / parse rules (P13, D11) and derive the sub key.

    The values stand behind a one-element ``explode``: the filter stays above it, so a row's
    look-ups in its event are made once, not again for each condition that reads them.
    """
    read = ["val", "grp", "item_ms"]
    once = F.explode(F.array(F.struct(*read))).alias("_read")
    routed = routed.select(*[c for c in routed.columns if c not in read], once).select("*", *[F.col("_read")[c].alias(c) for c in read])
    kind, ft, val = F.col("kind"), F.col("field_type"), F.col("val")
    as_long, as_double = val.try_cast("bigint"), val.try_cast("double")
    # SUM skips an unparsable value; MAX / MIN read it as 0
    x_long = F.when(ft == "long", F.when(kind == "sum", as_long).otherwise(F.coalesce(as_long, F.lit(0).cast("bigint"))))
    x_double = F.when(ft == "double", F.when(kind == "sum", as_double).otherwise(F.coalesce(as_double, F.lit(0.0))))
    keep = (
        F.when(kind == "count", ~F.col("grouped") | F.col("grp").isNotNull())
        .when(kind == "sum", F.coalesce(x_long.isNotNull(), F.lit(False)) | F.coalesce(x_double.isNotNull(), F.lit(False)))
        .when(kind.isin("max", "min"), val.isNotNull())
        .otherwise(val.isNotNull() & F.col("item_ms").isNotNull())
    )
    sub_key = F.when((kind == "count") & F.col("grouped"), F.col("grp")).otherwise(F.lit(""))
    return routed.where(keep).select(
        "id", "id_type", "feature", "kind", sub_key.alias("sub_key"), "cadence_ms", "event_ms",
        "val", "item_ms", "capacity",
        x_long.alias("x_long"), x_double.alias("x_double"), *extra,
    )


def _fixed_width_aggs():
    """COUNT / SUM / MAX / MIN partials: fixed-width buffers, so HashAggregate."""
    kind = F.col("kind")
    return [
        F.count(F.lit(1)).alias("cnt"),
        F.try_sum(F.when(kind == "sum", F.col("x_long"))).alias("_sum_l"),
        F.max(F.when(kind == "max", F.col("x_long"))).alias("_max_l"),
        F.min(F.when(kind == "min", F.col("x_long"))).alias("_min_l"),
        F.try_sum(F.when(kind == "sum", F.col("x_double"))).alias("_sum_d"),
        F.max(F.when(kind == "max", F.col("x_double"))).alias("_max_d"),
        F.min(F.when(kind == "min", F.col("x_double"))).alias("_min_d"),
    ]


NUMERIC_KINDS = ("count", "sum", "max", "min")
ITEM_KINDS = ("list", "set", "latest")


def partial_keys(rows: DataFrame):
    kind = F.col("kind")
    is_item = kind.isin(*ITEM_KINDS)
    return [F.when(is_item, F.col("val")).alias("_v"), F.when(kind == "list", F.col("item_ms")).alias("_t")]


def partial_aggs():
    return [*_fixed_width_aggs(), F.max("item_ms").alias("item_ms"), F.max("capacity").alias("capacity")]


#: What each kind fills of a partial, beside its count.
_FILLED = {"sum": ("_sum_l", "_sum_d"), "max": ("_max_l", "_max_d"), "min": ("_min_l", "_min_d"),
           **{k: ("item_ms", "capacity") for k in ITEM_KINDS}}
_AGGREGATED = ("cnt", "_sum_l", "_max_l", "_min_l", "_sum_d", "_max_d", "_min_d", "item_ms", "capacity")
_PARTIAL_TYPES = dict(c.split(" ") for c in PARTIAL_SCHEMA.split(", "))


def pane_partials(routed: DataFrame, kinds=()) -> DataFrame:
    """Level-1 partials for every kind and cadence in one map-side-combined aggregation.

    All buffers are fixed-width (counts, sums, extremes, times), which keeps
    it on the hash aggregate.  Numeric kinds group by the pane key; LIST by
    (pane, value, time), SET and LATEST by (pane, value) -- duplicates
    collapse map-side and a hot pane spreads over tasks by value.

    ``kinds`` names the kinds of the rows; without it there may be any.  Columns that none of them
    fills are null and take no part in the aggregate: its rows and its code grow with the kinds.

    Kinds added from outside, if ``kinds`` names any, aggregate apart from these:
    their binary states would take all rows off the hash aggregate.
    """
    added = added_kinds(kinds)
    shared = routed.where(~F.col("kind").isin(*[k.name for k in added])) if added else routed
    rows = contributing(shared).withColumn("pane_end_ms", pane_end_ms(F.col("event_ms"), F.col("cadence_ms")))
    builtin = [k for k in kinds if k in NUMERIC_KINDS + ITEM_KINDS] or NUMERIC_KINDS + ITEM_KINDS
    filled = {"cnt", *[c for k in builtin for c in _FILLED.get(k, ())]}
    value, time = partial_keys(rows)
    keyed = {"_v": value if set(builtin) & set(ITEM_KINDS) else None, "_t": time if "list" in builtin else None}
    aggs = [agg for name, agg in zip(_AGGREGATED, partial_aggs(), strict=True) if name in filled]
    grouped = rows.groupBy(*PANE_KEYS, *[k for k in keyed.values() if k is not None]).agg(*aggs)
    out = grouped.select(*PANE_KEYS, *[F.col(c) if c in grouped.columns else F.lit(None).cast(t).alias(c) for c, t in _PARTIAL_TYPES.items() if c not in PANE_KEYS])
    for kind in added:
        out = out.unionByName(_state_partials(routed, kind), allowMissingColumns=True)
    return out


def _state_partials(routed: DataFrame, kind: FeatureKind) -> DataFrame:
    rows = routed.where((F.col("kind") == kind.name) & kind.pane.keep()).withColumn("sub_key", kind.pane.sub_key())
    rows = rows.withColumn("pane_end_ms", pane_end_ms(F.col("event_ms"), F.col("cadence_ms")))
    return rows.groupBy(*PANE_KEYS).agg(F.count(F.lit(1)).alias("cnt"), kind.pane.partial().alias("state"))


def combine_aggs() -> list:
    """The aggregates that merge partials of one group."""
    lost = (F.col("kind") == "sum") & F.col("_sum_l").isNull() & F.col("_sum_d").isNull()
    return [F.sum("cnt").alias("cnt"), F.when(~F.max(lost), F.try_sum("_sum_l")).alias("_sum_l"), F.max("_max_l").alias("_max_l"),
            F.min("_min_l").alias("_min_l"), F.try_sum("_sum_d").alias("_sum_d"), F.max("_max_d").alias("_max_d"), F.min("_min_d").alias("_min_d"),
            F.max("item_ms").alias("item_ms"), F.max("capacity").alias("capacity")]


def combine_partials(partials: DataFrame, kinds=()) -> DataFrame:
    """Partials of the same (pane, entry) merged into one: the associative combine of every kind.

    Sums add up (a long sum that left its type stays lost), counts add up,
    extremes and times take their extremes; entries are part of the key.  Kinds added
    from outside, if ``kinds`` names any, merge their states themselves.
    """
    added = added_kinds(kinds)
    shared = partials.where(~F.col("kind").isin(*[k.name for k in added])) if added else partials
    out = shared.groupBy(*PANE_KEYS, "_v", "_t").agg(*combine_aggs()).withColumn("state", F.lit(None).cast("binary"))
    for kind in added:
        merged = partials.where(F.col("kind") == kind.name).groupBy(*PANE_KEYS).agg(F.sum("cnt").alias("cnt"), kind.pane.combine("state").alias("state"))
        out = out.unionByName(merged, allowMissingColumns=True)
    return out


def coarser_partials(partials: DataFrame, cadences: DataFrame) -> DataFrame:
    """Base-cadence partials placed in the panes of every cadence their feature has.

    ``cadences`` holds ``(feature, id_type, cadence_ms)``; every cadence is a
    multiple of the base.  Not combined yet, so that panes can be chosen first.
    """
    placed = partials.drop("cadence_ms").join(cadences, ["feature", "id_type"])
    width = F.col("cadence_ms")
    return placed.withColumn("pane_end_ms", (F.ceil(F.col("pane_end_ms") / width) * width).cast("bigint"))


def pane_partials_streaming(routed: DataFrame, pane_ms: int) -> DataFrame:
    """The same partials as a stateful streaming aggregation.

    ``routed`` carries the watermarked ``event_ts``; state rows are keyed like
    the batch partials, so no state row grows with a pane's distinct values.
    Append mode emits a pane's partials once, when the watermark passes it.
    """
    rows = contributing(routed, extra=("event_ts",))
    pane = F.window("event_ts", f"{pane_ms // 1000} seconds")
    keys = ["id", "id_type", "feature", "kind", "sub_key", "cadence_ms"]
    agg = rows.groupBy(pane.alias("pane"), *keys, *partial_keys(rows)).agg(*partial_aggs())
    return agg.select(*keys, F.unix_millis(F.col("pane.end")).alias("pane_end_ms"),
                      *[c for c in agg.columns if c not in ("pane", *keys)])


def panes_from_partials(partials: DataFrame, max_capacity: int | None = None,
                        kinds: set[str] | None = None) -> DataFrame:
    """Partials -> the pane table: numeric rows as they are; item kinds keep
    their newest ``capacity`` entries per pane (LATEST: one) with
    ``row_number`` -- the literal bound lets WindowGroupLimit trim each task's
    candidates before the exchange."""
    kinds = set(NUMERIC_KINDS + ITEM_KINDS) if kinds is None else set(kinds)
    parts = []
    if added := added_kinds(kinds):
        states = partials.where(F.col("kind").isin(*[k.name for k in added])).select(*PANE_KEYS, "cnt", "state")
        nulls = _item_panes(partials.where(F.lit(False)), max_capacity)
        parts.append(nulls.unionByName(states, allowMissingColumns=True))
    if kinds & set(NUMERIC_KINDS):
        parts.append(partials.where(F.col("kind").isin(*NUMERIC_KINDS)).select(
            *PANE_KEYS, "cnt",
            F.coalesce("_sum_l", "_max_l", "_min_l").alias("num_long"),
            F.coalesce("_sum_d", "_max_d", "_min_d").alias("num_double"),
            F.lit(None).cast(ITEM_TYPE).alias("items"),
            F.lit(None).cast("string").alias("latest_value"), F.lit(None).cast("bigint").alias("latest_ms"),
            F.lit(None).cast("binary").alias("state"),
        ))
    if kinds & set(ITEM_KINDS):
        parts.append(_item_panes(partials.where(F.col("kind").isin(*ITEM_KINDS)), max_capacity))
    if not parts:
        return _item_panes(partials.where(F.lit(False)), max_capacity)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def build_panes(routed: DataFrame, max_capacity: int | None = None,
                kinds: set[str] | None = None) -> DataFrame:
    """Batch pane build over routed long rows (output of ``route_windowed``).

    Lazy form; ``FeatureJob.materialized_panes`` persists the partials first
    so the parse runs once for both the numeric and the item branch.
    """
    return panes_from_partials(pane_partials(routed, kinds or ()), max_capacity, kinds)


def _item_panes(candidates: DataFrame, max_capacity: int | None) -> DataFrame:
    # times first: they alone decide most comparisons of the sorts
    keys = ["pane_end_ms", *[k for k in PANE_KEYS if k != "pane_end_ms"]]
    newest = Window.partitionBy(*keys).orderBy(F.col("item_ms").desc(), F.col("_v").desc())
    ranked = candidates.withColumn("_rn", F.row_number().over(newest))
    ranked = ranked.where(F.col("_rn") <= F.lit(max(int(max_capacity or 1), 1)))
    keep = F.when(F.col("kind") == "latest", F.lit(1)).otherwise(F.col("capacity"))
    is_latest = F.col("kind") == "latest"
    return (
        ranked.where(F.col("_rn") <= keep)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            F.collect_list(F.when(~is_latest, F.struct(
                F.col("item_ms").alias("ts"), F.col("_v").alias("value")))).alias("items"),
            F.max(F.when(is_latest, F.col("_v"))).alias("latest_value"),
            F.max(F.when(is_latest, F.col("item_ms"))).alias("latest_ms"),
        )
        .select(
            *PANE_KEYS, "cnt", F.lit(None).cast("bigint").alias("num_long"),
            F.lit(None).cast("double").alias("num_double"),
            F.when(F.size("items") > 0, F.sort_array("items", asc=False)).alias("items"),
            "latest_value", "latest_ms", F.lit(None).cast("binary").alias("state"),
        )
    )


def retention_ms(cs) -> DataFrame:
    """Per (feature, id_type): how long its panes are needed.

    At least one hour, the longest look-back, a day for ``today`` and two
    days for ``yesterday``.
    """
    whole = {"today": 24 * 3_600_000, "yesterday": 48 * 3_600_000}
    id_types = {r.spec_id: r.id_type for r in cs.rows["specs"]}
    kept: dict[tuple, int] = {}
    for w in cs.rows["windows"]:
        key = (w.feature, id_types[w.spec_id])
        kept[key] = max(kept.get(key, 3_600_000), w.window_ms if w.window_ms is not None else whole.get(w.whole, 0))
    from tumbleweed.plans.compile import literal_table

    return literal_table(cs.specs.sparkSession, sorted((*key, ms) for key, ms in kept.items()), "feature string, id_type string, retention_ms bigint")


def retain_panes(panes: DataFrame, cs, as_of_ms, pane_ms: int) -> DataFrame:
    """Panes still inside their retention as of ``as_of_ms``.

    A broadcast join with the per-feature retention, then a filter; on a
    date-partitioned pane table the same predicate prunes whole partitions.
    """
    from tumbleweed.plans.compile import spec_broadcast

    kept = panes.join(spec_broadcast(retention_ms(cs), len(cs.rows["windows"])), ["feature", "id_type"])
    return kept.where(F.col("pane_end_ms") > F.lit(as_of_ms) - F.col("retention_ms")).drop("retention_ms")
