"""Roll-up: pane partials -> windowed features (A1-A8 level 2, W2-W4, W8, A11, J3).

Every (entity, feature) with a partial in a pane emits its features at that
pane's end (A11).  Time is cut into blocks, of the look-back's length or days, and
work is dealt by (key, block), numbers by spans of ``SPAN`` look-backs: a busy key is spread over them, and no task
sorts or holds more than the panes of one block, span or day, of one key.

* COUNT, SUM, MAX, MIN over ``(T - w, T]`` (decision D2): the end of one time
  block merged with the beginning of the next, both growing frames; all kinds
  in the same passes.
* ``today``: growing frame within the local day; ``yesterday``: totals of days,
  joined with the next day's panes.
* grouped COUNT: a group's first and last pane of each block tell which active
  panes see it, so groups absent from the current pane are carried over (A2).
* LIST and SET: running merges of at most ``capacity`` items.

Panes may have a boolean column ``wanted`` (the stream's batches): features are made
at the panes where it holds, the others are only looked back on.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tumbleweed.functions.scalars import local_day_num
from tumbleweed.operators.panes import ITEM_TYPE
from tumbleweed.plans.compile import CompiledSpecs, literal_table, spec_broadcast, unbroadcast
from tumbleweed.plans.kinds import KIND_REGISTRY, FeatureKind, added_kind, register_kind
from tumbleweed.sources.events import DEFAULT_EVENT_TIME_FIELD

ENTITY = ["id", "id_type", "feature"]
FEATURE_COLUMNS = ["id", "id_type", "feature", "feature_name", "window", "ts",
                   "value_long", "value_double", "value_text", "value_type"]


#: Optional column of panes: whether features are made there.  All panes of an entity and time agree.
WANTED = "wanted"


def _flag(panes: DataFrame) -> Column:
    return (F.col(WANTED) if WANTED in panes.columns else F.lit(True)).alias(WANTED)


def _params(cs: CompiledSpecs, ids) -> DataFrame:
    """What the roll-ups read of these specs, to be joined with their panes: one table made on the driver, so a broadcast takes no plan of its own."""
    rows = [(r.spec_id, r.feature, r.id_type, r.kind, r.field_type, r.capacity, r.need_ts) for r in cs.rows["specs"] if r.spec_id in ids]
    return spec_broadcast(literal_table(cs.specs.sparkSession, rows, "spec_id int, feature string, id_type string, spec_kind string, field_type string, capacity int, need_ts boolean"), len(rows))


def _named_windows(cs: CompiledSpecs, wins) -> DataFrame:
    """These windows with what their spec's number stands for; those in days have the length ``WHOLE_DAY``."""
    specs = {r.spec_id: r for r in cs.rows["specs"]}
    rows = [(*_length(w), w.window, w.whole, *[getattr(specs[w.spec_id], c) for c in ("feature", "id_type", "kind", "field_type", "need_ts")]) for w in wins]
    schema = "spec_id int, window_ms bigint, window string, whole string, feature string, id_type string, spec_kind string, field_type string, need_ts boolean"
    return spec_broadcast(literal_table(cs.specs.sparkSession, rows, schema), len(rows))


def _windows(cs: CompiledSpecs, pane_ms: int) -> DataFrame:
    return spec_broadcast(cs.windows.where(F.col("cadence_ms") == pane_ms).select(
        "spec_id", "window", "window_ms", "whole"), len(cs.rows["windows"]))


def _emit(df: DataFrame, name: Column, long_v: Column, double_v: Column, text_v: Column,
          vtype: Column) -> DataFrame:
    return df.select(
        "id", "id_type", "feature", name.alias("feature_name"), "window",
        F.col("pane_end_ms").alias("ts"),
        long_v.cast("bigint").alias("value_long"), double_v.cast("double").alias("value_double"),
        text_v.cast("string").alias("value_text"), vtype.alias("value_type"),
    )


def _none(panes: DataFrame) -> DataFrame:
    """An empty feature frame (a kind without specs at this cadence)."""
    return _emit(panes.where(F.lit(False)).withColumn("window", F.lit(None).cast("string")), F.lit(""),
                 F.lit(None), F.lit(None), F.lit(None), F.lit(""))


# --------------------------------------------------------------------------- numeric
# Stands for a pane sum that left BIGINT: no window that holds it comes back into range.
BEYOND_BIGINT = "1" + "0" * 28


@dataclass(frozen=True)
class State:
    """A running aggregate of the roll-up: input column, aggregate, and how two results merge."""

    value: Column
    agg: Callable[[Column], Column]
    merge: Callable[[Column, Column], Column]


def _plus(x: Column, y: Column) -> Column:
    return F.try_add(x, F.coalesce(y, F.lit(0)))


def _states(kinds: set[tuple[str, str | None]]) -> dict[str, State]:
    """The states that these (kind, field type) pairs need; a row fills the one of its kind.

    A long SUM runs in DECIMAL and is NULL where the window's sum, or the sum of
    a pane in it, leaves BIGINT (D16).  MAX and MIN run over ``struct(long,
    double)``, so long and double specs share one function.
    """
    of = lambda kind, x: F.when(F.col("spec_kind") == kind, x)
    # a SUM pane always has a contributing value: a missing sum is one that left BIGINT
    exact = F.coalesce(F.col("num_long").cast("decimal(38,0)"), F.lit(BEYOND_BIGINT).cast("decimal(38,0)"))
    either = F.struct(F.col("num_long").alias("l"), F.col("num_double").alias("d"))
    is_long = F.col("field_type") == "long"
    found = {}
    if any(k == "count" for k, _ in kinds):
        found["n"] = State(of("count", F.col("cnt")), F.sum, _plus)
    if ("sum", "long") in kinds:
        found["s"] = State(of("sum", F.when(is_long, exact)), F.try_sum, _plus)
    if ("sum", "double") in kinds:
        found["d"] = State(of("sum", F.when(~is_long, F.col("num_double"))), F.try_sum, _plus)
    if any(k == "max" for k, _ in kinds):
        found["hi"] = State(of("max", either), F.max, F.greatest)
    if any(k == "min" for k, _ in kinds):
        found["lo"] = State(of("min", either), F.min, F.least)
    return found


def rollup_numeric(panes: DataFrame, cs: CompiledSpecs, pane_ms: int, tz: str | None = None) -> DataFrame:
    """COUNT (ungrouped), SUM, MAX, MIN over relative and whole-day windows.

    All kinds share their passes: a row has the states of its own kind and nulls
    for the others, and goes once to each look-back length its spec has.

    * look-backs: time is cut into blocks of length ``w``; a look-back is the
      end of one block and the beginning of the next (:func:`_both_parts`) --
      linear, without cancellation.  Rows are dealt by spans of time
      (:func:`_in_spans`), once for all lengths, and a busy key is spread over its spans;
    * whole days run in the same pass, as blocks of a day: ``today`` is the beginning
      of the day's block, ``yesterday`` all of the block before.  A busy key is
      spread over its days.
    """
    specs = [r for r in cs.rows["specs"] if r.kind in ("sum", "max", "min") or (r.kind == "count" and r.group_by is None)]
    ids = {r.spec_id for r in specs}
    wins = [w for w in cs.rows["windows"] if w.spec_id in ids and w.cadence_ms == pane_ms]
    if not wins:
        return _none(panes)
    used = {w.spec_id for w in wins}
    states = _states({(r.kind, r.field_type if r.kind != "count" else None) for r in specs if r.spec_id in used})
    # shuffles carry the spec's number only: what it stands for is joined again with the windows
    p = panes.where(F.col("kind").isin(*sorted({r.kind for r in specs}))).join(_params(cs, used), ["feature", "id_type"]).select(
        "id", "spec_id", "pane_end_ms", _flag(panes), *[v.value.alias(k) for k, v in states.items()],
        local_day_num(F.col("pane_end_ms") - F.lit(pane_ms), tz).cast("bigint").alias("day"))
    placed = _in_spans(p, cs, wins, ["id", "spec_id"], "pane_end_ms", states, "day")
    done = _both_parts(placed, ["id", "spec_id", "span_ms", "part", "window_ms", "b"], "pane_end_ms", states, follows=True)
    rows = done.join(_named_windows(cs, wins), ["spec_id", "window_ms"]).where(F.col("whole").isNull() | (F.col("whole") == "today") | F.col("follows"))
    whole = F.col("whole")
    rows = rows.select(*ENTITY, "spec_kind", "field_type", "pane_end_ms", "window", *[
        F.when(whole.isNull(), v.merge(F.col(f"head_{k}"), F.col(f"tail_{k}"))).when(whole == "today", F.col(f"head_{k}")).otherwise(F.col(f"tail_{k}")).alias(k)
        for k, v in states.items()])
    state = lambda k: F.col(k) if k in states else F.lit(None)
    extreme = F.coalesce(*[F.col(k) for k in ("hi", "lo") if k in states]) if {"hi", "lo"} & set(states) else None
    is_double = F.col("field_type") == "double"
    kind = F.col("spec_kind")
    long_v = F.when(kind == "count", state("n")).when(kind == "sum", state("s").try_cast("bigint"))
    double_v = F.when(kind == "sum", state("d"))
    if extreme is not None:
        long_v = long_v.when(kind.isin("max", "min") & ~is_double, extreme["l"])
        double_v = double_v.when(kind.isin("max", "min") & is_double, extreme["d"])
    text = F.coalesce(long_v.cast("string"), double_v.cast("string"))
    vtype = F.when((kind != "count") & is_double, F.lit("double")).otherwise(F.lit("long"))
    # a sum beyond its type emits NULL
    return _emit(rows.where((kind == "sum") | text.isNotNull()), F.concat_ws("_", "feature", "window"), long_v, double_v, text, vtype)


#: Stands for the length of whole-day windows.
WHOLE_DAY = -1


def _lengths(cs: CompiledSpecs, pane_ms: int, ids, whole_days: bool = False) -> DataFrame:
    """``(spec_id, window_ms)``: the look-back lengths of these specs, each once.

    With ``whole_days`` also ``WHOLE_DAY`` for those in days, and ``moves``: whether panes are looked back on from the next block, which
    ``today`` alone never does, and ``stays``: whether from their own, which ``yesterday`` alone never does.
    """
    wins = [w for w in cs.rows["windows"] if w.spec_id in ids and w.cadence_ms == pane_ms and (w.whole is None or whole_days)]
    if not whole_days:
        rows, schema = sorted({_length(w) for w in wins}), "spec_id int, window_ms bigint"
    else:
        moving, staying = ({_length(w) for w in wins if w.whole != other} for other in ("today", "yesterday"))
        rows = sorted({(*_length(w), _length(w) in moving, _length(w) in staying) for w in wins})
        schema = "spec_id int, window_ms bigint, moves boolean, stays boolean"
    return spec_broadcast(literal_table(cs.specs.sparkSession, rows, schema), len(rows))


def _length(w) -> tuple[int, int]:
    return w.spec_id, WHOLE_DAY if w.whole is not None else w.window_ms


def _block(t: str) -> Column:
    """Number of the block ``(b * w, (b + 1) * w]`` that holds a pane end."""
    return F.floor((F.col(t) - 1) / F.col("window_ms"))


#: After every pane of a block.
END_OF_BLOCK = (1 << 63) - 1


#: Look-backs of a spec, the longest it has, in a span.
SPAN = 2


def _in_spans(rows: DataFrame, cs: CompiledSpecs, wins, key: list[str], t: str, states: dict[str, State], day: str) -> DataFrame:
    """Rows dealt by spans of time and then placed in the blocks of every look-back of their spec (see :func:`_both_parts`).

    What is shuffled does not grow with the number of look-backs: a row goes to its span, which is ``SPAN`` times the
    spec's longest look-back, and once more to the next one if a look-back there may reach it.  Blocks are cut inside
    a span, the last one may be shorter; what came from the span before counts as moved to the first.
    A task holds a span, or day, of one key.

    Rows of whole-day windows have days for spans and for blocks; there, ``day`` being the column of day numbers, they
    move to the end of the next one, so its every row sees the whole day before.
    """
    longest: dict[int, int] = {}
    for w in wins:
        if w.whole is None:
            longest[w.spec_id] = max(w.window_ms, longest.get(w.spec_id, 0))
    moving = {w.spec_id for w in wins if w.whole == "yesterday"}
    spans = sorted({(w.spec_id, *((SPAN * longest[w.spec_id], longest[w.spec_id]) if w.whole is None else (WHOLE_DAY, 1 if w.spec_id in moving else 0))) for w in wins})
    lengths = sorted({(*_length(w), SPAN * longest[w.spec_id] if w.whole is None else WHOLE_DAY) for w in wins})
    table = lambda rows, schema: spec_broadcast(literal_table(cs.specs.sparkSession, rows, schema), len(rows))
    spanned = rows.join(table(spans, "spec_id int, span_ms bigint, reach_ms bigint"), "spec_id")
    flag = [WANTED] if WANTED in rows.columns else []
    whole = F.col("span_ms") == F.lit(WHOLE_DAY)
    part = F.when(whole, F.col(day)).otherwise(F.floor((F.col(t) - 1) / F.col("span_ms")))
    reached = F.when(whole, F.col("reach_ms") > 0).otherwise(F.col(t) > (part + 1) * F.col("span_ms") - F.col("reach_ms"))
    dealt = spanned.withColumn("home", F.explode(F.when(reached, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True))))).select(
        *key, "span_ms", F.when(F.col("home"), part).otherwise(part + 1).alias("part"), t, "home", *flag, *states).repartition(*[F.col(c) for c in [*key, "span_ms", "part"]])
    w, since = F.col("window_ms"), F.col(t) - F.col("part") * F.col("span_ms")
    home, block = F.col("home"), F.floor((since - 1) / w)
    near = dealt.join(table(lengths, "spec_id int, window_ms bigint, span_ms bigint"), ["spec_id", "span_ms"]).where(home | whole | (since > -w))
    places = (F.when(~home, F.array(F.lit(0))).when(whole | ((block + 1) * w >= F.col("span_ms")), F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(0))))
    own = F.col("own") == 1
    return near.withColumn("own", F.explode(places)).select(
        *key, "span_ms", "part", "window_ms", F.when(home & ~whole, block + 1 - F.col("own")).otherwise(F.lit(0)).alias("b"),
        F.when(own, F.col(t)).when(whole, F.lit(END_OF_BLOCK)).otherwise(F.col(t) + w).alias("at"), "own", *flag, *states)


def _two_blocks(rows: DataFrame, key: list[str], t: str, states: dict[str, State]) -> DataFrame:
    """Both parts of every state over ``(T - w, T]`` for each wanted row; ``rows`` hold one row per ``key``, ``window_ms`` (w) and ``t``."""
    moved = F.lit(1) - F.col("own")
    flag = [WANTED] if WANTED in rows.columns else []
    placed = rows.withColumn("own", F.explode(F.array(F.lit(1), F.lit(0)))).select(
        *key, "window_ms", (_block(t) + moved).alias("b"), (F.col(t) + moved * F.col("window_ms")).alias("at"), "own", *flag, *states)
    return _both_parts(placed, [*key, "window_ms", "b"], t, states)


def _both_parts(placed: DataFrame, keys: list[str], t: str, states: dict[str, State], follows: bool = False) -> DataFrame:
    """Both parts of every state over ``(T - w, T]`` for each wanted row, in linear time: ``head_`` and ``tail_``.

    With blocks ``(b * w, (b + 1) * w]``, the look-back of a row in block
    ``b`` is the part of block ``b - 1`` after ``T - w`` and the part of block ``b``
    up to ``T``.  Both are growing frames inside one block.  Each row is
    in its own block ``at`` its time and in the next one at ``t + w``: there, backwards in
    time, the moved rows seen before ``T`` are those of the block before after ``T - w``.
    One shuffle serves both frames; a row carries each state once, and ``own`` tells which frame it counts in.
    ``follows`` tells whether there is anything in the block before, as far as it was moved.
    """
    own = F.col("own") == 1
    flag = [WANTED] if WANTED in placed.columns else []
    in_block = Window.partitionBy(*keys)
    so_far = in_block.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    # a moved row exactly at T is outside
    backwards = in_block.orderBy(F.desc("at"), F.desc("own")).rowsBetween(Window.unboundedPreceding, 0)
    more = [(F.min("own").over(backwards) == 0).alias("follows")] if follows else []
    both = placed.select(*keys, "at", "own", *flag, *[v.agg(F.when(own, F.col(k))).over(so_far).alias(f"head_{k}") for k, v in states.items()],
                         *[v.agg(F.when(~own, F.col(k))).over(backwards).alias(f"tail_{k}") for k, v in states.items()], *more)
    kept = both.where(own & F.col(WANTED)) if flag else both.where(own)
    return kept.select(*keys, F.col("at").alias(t), *[f"{part}_{k}" for k in states for part in ("head", "tail")], *(["follows"] if follows else []))


# --------------------------------------------------------------------------- grouped count
GROUP = ENTITY + ["sub_key"]


def _seen_pairs(ends: DataFrame, active: DataFrame, lengths: DataFrame) -> DataFrame:
    """The entity's active panes, each with the groups seen in its look-back.

    ``ends`` holds the first (``since``) and last pane of each (group, block).
    """
    blocked = [*GROUP, "spec_id", "window_ms", "b"]
    nothing = F.lit(None).cast("bigint")
    here = ends.select(*blocked, "since", nothing.alias("until"))
    after = ends.select(*GROUP, "spec_id", "window_ms", (F.col("b") + 1).alias("b"), nothing.alias("since"), (F.col("last") + F.col("window_ms")).alias("until"))
    seen = here.unionByName(after).groupBy(*blocked).agg(F.max("since").alias("since"), F.max("until").alias("until"))
    probes = active.join(lengths, "spec_id").withColumn("b", _block("t"))
    return probes.join(unbroadcast(seen), [*ENTITY, "spec_id", "window_ms", "b"]).where((F.col("t") >= F.col("since")) | (F.col("t") < F.col("until")))


def rollup_grouped_count(panes: DataFrame, cs: CompiledSpecs, pane_ms: int, tz: str | None = None) -> DataFrame:
    """Grouped COUNT: every group seen in the look-back, at every active pane (A2).

    Nothing gathers all groups of an entity, or a group's whole history: work is
    partitioned by (entity, group, block) wherever it can be, and by (entity,
    block) where groups meet the entity's active panes.

    1. presence -- a group is seen from a pane ``T`` of block ``b`` if its first
       pane there is no later, or its last pane of block ``b - 1`` is after
       ``T - w``: two extremes per (entity, group, block), combined map-side, and
       the total of block ``b - 1``;
    2. pairs    -- presence joins the entity's active panes on (entity, w, block):
       exactly the output (group, pane) pairs, which AQE may split;
    3. values   -- pairs join the group's own panes as zero-count probes; a pane
       adds its count at ``t`` and takes it back at ``t + w``, so a running total
       in (entity, group, block), with the total of the block before, is each look-back's count.

    Whole days go the same way, with days for blocks: ``today`` is the running total
    of the day's block, ``yesterday`` the total of the one before.
    """
    ids = {r.spec_id for r in cs.rows["specs"] if r.kind == "count" and r.group_by is not None}
    wins = [w for w in cs.rows["windows"] if w.spec_id in ids and w.cadence_ms == pane_ms]
    if not wins:
        return _none(panes)

    gp = panes.where(F.col("kind") == "count").join(_params(cs, ids), ["feature", "id_type"]).select(
        "id", "spec_id", "sub_key", F.col("pane_end_ms").alias("t"), F.col("cnt").alias("c"), _flag(panes),
        local_day_num(F.col("pane_end_ms") - F.lit(pane_ms), tz).cast("bigint").alias("day"))
    lengths = _lengths(cs, pane_ms, ids, whole_days=True)
    block = ["id", "spec_id", "window_ms", "b"]
    own, whole = F.col("own") == 1, F.col("window_ms") == F.lit(WHOLE_DAY)
    at_block = F.when(whole, F.col("day")).otherwise(_block("t"))
    active = gp.where(F.col(WANTED)).select("id", "spec_id", "t", "day").distinct().join(lengths, "spec_id").withColumn("b", at_block)
    # a pane counts in its own block, and in the next one, until it leaves the look-back
    places = F.when(F.col("moves") & F.col("stays"), F.array(F.lit(1), F.lit(0))).when(F.col("stays"), F.array(F.lit(1))).otherwise(F.array(F.lit(0)))
    placed = gp.join(lengths, "spec_id").withColumn("own", F.explode(places)).select(
        "id", "spec_id", "sub_key", "window_ms", (at_block + F.lit(1) - F.col("own")).alias("b"), "own",
        F.when(own, F.col("t")).when(whole, F.lit(END_OF_BLOCK)).otherwise(F.col("t") + F.col("window_ms")).alias("t"), "c")
    seen = placed.groupBy(*block, "sub_key").agg(F.min(F.when(own, F.col("t"))).alias("since"), F.max(F.when(~own, F.col("t"))).alias("until"),
                                                 F.sum(F.when(~own, F.col("c"))).alias("prior"))
    here = F.coalesce(F.col("t") >= F.col("since"), F.lit(False))
    pairs = active.join(unbroadcast(seen), block).where(here | (F.col("t") < F.col("until"))).select(*block, "sub_key", "t", "prior", here.alias("here"))
    # a block starts with the total of the one before and takes each pane back when it leaves the look-back
    nothing = F.lit(None).cast("bigint")
    mixed = (placed.where(own | ~whole).select(*block, "sub_key", "t", F.when(own, F.col("c")).otherwise(-F.col("c")).alias("c"), nothing.alias("prior"), F.lit(None).cast("boolean").alias("here"))
             .unionByName(pairs.withColumn("c", F.lit(0).cast("bigint"))))
    so_far = F.sum("c").over(Window.partitionBy(*block, "sub_key").orderBy("t").rangeBetween(Window.unboundedPreceding, 0))
    done = mixed.withColumn("running", so_far).where(F.col("here").isNotNull())
    rows = done.join(_named_windows(cs, wins), ["spec_id", "window_ms"]).where(
        F.col("whole").isNull() | ((F.col("whole") == "today") & F.col("here")) | ((F.col("whole") == "yesterday") & F.col("prior").isNotNull()))
    total = F.when(F.col("whole") == "yesterday", F.col("prior")).when(F.col("whole") == "today", F.col("running")).otherwise(
        F.col("running") + F.coalesce("prior", F.lit(0)))
    return _emit(
        rows.withColumn("total", total).withColumnRenamed("t", "pane_end_ms"), F.concat_ws("_", "feature", "sub_key", "window"),
        F.col("total"), F.lit(None), F.col("total").cast("string"), F.lit("long"),
    )


# --------------------------------------------------------------------------- list / set
def _render_items(items: Column, need_ts: Column) -> Column:
    """JSON array of ``value`` or ``value|ts`` strings."""
    return F.to_json(F.transform(items, lambda x: F.when(
        need_ts, F.concat(x["value"], F.lit("|"), x["ts"].cast("string"))).otherwise(x["value"])))


def rollup_items(panes: DataFrame, cs: CompiledSpecs, pane_ms: int, kind: str, clock_field: str = DEFAULT_EVENT_TIME_FIELD) -> DataFrame:
    """LIST: the newest ``capacity`` (value, time) items in the look-back (A6).  SET: the newest
    ``capacity`` distinct values, each at its newest time (A7, D5).
    """
    parts = []
    for on_clock in (True, False):
        ids = {r.spec_id for r in cs.rows["specs"] if r.kind == kind and (r.time_field == clock_field) == on_clock}
        wins = [w for w in cs.rows["windows"] if w.spec_id in ids and w.cadence_ms == pane_ms and w.whole is None]
        if not wins:
            continue
        params = _params(cs, ids)
        found = panes.where(F.col("kind") == kind).join(params, ["feature", "id_type"])
        windows = _windows(cs, pane_ms).where(F.col("whole").isNull())
        longest = max(w.window_ms for w in wins)
        if longest // pane_ms <= ARRAY_PANES:
            p = found.select("id", "spec_id", F.col("pane_end_ms").alias("t"), "items", _flag(panes))
            named = _named_windows(cs, wins).select("spec_id", "window", "window_ms", "feature", "id_type", "need_ts")
            rows = _items_on_clock(p, cs, wins, pane_ms, kind == "set", named) if on_clock else _items_in_blocks(
                p.join(_lengths(cs, pane_ms, ids), "spec_id"), cs, kind == "set", ids).join(named, ["spec_id", "window_ms"])
        else:
            p = found.select(*ENTITY, "spec_id", F.col("pane_end_ms").alias("t"), "items", "capacity", "need_ts", _flag(panes)).join(_lengths(cs, pane_ms, ids), "spec_id")
            rows = _newest_items(p, pane_ms, kind == "set", on_clock).join(windows, ["spec_id", "window_ms"])
        parts.append(_emit(rows.withColumnRenamed("t", "pane_end_ms"), F.concat_ws("_", "feature", "window"), F.lit(None), F.lit(None),
                           _render_items(F.col("items"), F.col("need_ts")), F.lit(kind)))
    if not parts:
        return _none(panes)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _merged(x: Column, y: Column, capacity: Column, distinct_values: bool) -> Column:
    """The newest ``capacity`` items of two arrays: the associative merge of LIST and SET."""
    both = F.sort_array(F.concat(x, y), asc=False)
    if distinct_values:  # newest first: a value's first item is its newest
        both = F.aggregate(both, F.array().cast(ITEM_TYPE), lambda acc, e: F.when(F.exists(acc, lambda a: a["value"] == e["value"]), acc).otherwise(F.concat(acc, F.array(e))))
    return F.slice(both, 1, capacity)


def _once(c: Column) -> Column:
    """``c`` computed once: the optimiser copies a projected expression to each place that reads it, but not past an ``explode``."""
    return F.explode(F.array(c))


def _running(cells: Column, capacity: Column, distinct_values: bool) -> Column:
    """For an array of ``(t, items)``: the merge of all items up to each ``t``."""
    none = F.filter(cells, lambda c: F.lit(False))
    last = lambda acc: F.coalesce(F.try_element_at(acc, F.lit(-1))["items"], F.array().cast(ITEM_TYPE))
    return F.aggregate(cells, none, lambda acc, c: F.concat(acc, F.array(F.struct(
        c["t"].alias("t"), _merged(last(acc), c["items"], capacity, distinct_values).alias("items"), c[WANTED].alias(WANTED)))))


def _with_running(grouped, capacity: Column, distinct_values: bool, on_clock: bool) -> DataFrame:
    """Each group's panes in time order, as running merges: ``heads``, and ``tails`` (backwards) unless items follow the clock."""
    cells = grouped.agg(F.array_sort(F.collect_list(F.struct("t", "items", WANTED))).alias("panes"),
                        F.first("capacity").alias("capacity"), F.first("need_ts").alias("need_ts"))
    cells = cells.withColumn("heads", _once(_running(F.col("panes"), capacity, distinct_values)))
    return cells if on_clock else cells.withColumn("tails", _once(_running(F.reverse("panes"), capacity, distinct_values)))


def _panes_of(on_clock: bool) -> Column:
    return F.explode("heads" if on_clock else F.zip_with("heads", F.reverse("tails"), lambda h, s: F.struct(
        h["t"].alias("t"), h["items"].alias("items"), s["items"].alias("rest"), h[WANTED].alias(WANTED))))


#: Panes of a look-back up to which its block is one array.
ARRAY_PANES = 2048


def _capacities(cs: CompiledSpecs, ids, *more: tuple[str, dict]) -> DataFrame:
    """``(spec_id, capacity)`` of these specs, and more bigint columns by spec."""
    rows = sorted((r.spec_id, r.capacity, *[values[r.spec_id] for _, values in more]) for r in cs.rows["specs"] if r.spec_id in ids)
    return spec_broadcast(literal_table(cs.specs.sparkSession, rows, ", ".join(["spec_id int, capacity int", *[f"{name} bigint" for name, _ in more]])), len(rows))


def _merged_sorted(x: Column, y: Column, capacity: Column, distinct_values: bool, y_older: bool) -> Column:
    """:func:`_merged` of two arrays that are such results themselves, or items of a pane: newest first, values distinct for SET.

    Only values in both arrays can come twice, and where all of ``y`` is older nothing is sorted.
    """
    if distinct_values:
        same = lambda a, e: a["value"] == e["value"]
        if y_older:
            y = F.filter(y, lambda e: ~F.exists(x, lambda a: same(a, e)))
        else:
            x, y = (F.filter(x, lambda e: ~F.exists(y, lambda a: same(a, e) & (a["ts"] > e["ts"]))),
                    F.filter(y, lambda e: ~F.exists(x, lambda a: same(a, e) & (a["ts"] >= e["ts"]))))
    both = F.concat(x, y)
    return F.slice(both if y_older else F.sort_array(both, asc=False), 1, capacity)


def _blocks(p: DataFrame, key: list[str], length: str, at: Column) -> DataFrame:
    """Per key and block, the cells ``(at, own, live, items)`` of its own panes and of the block before's, in one exchange.

    Only blocks with a pane that features are made at.
    """
    own = F.col("own") == 1
    placed = p.withColumn("own", F.explode(F.array(F.lit(1), F.lit(0)))).select(
        *key, (F.floor((F.col("t") - 1) / F.col(length)) + F.lit(1) - F.col("own")).alias("b"),
        F.struct(F.when(own, F.col("t")).otherwise(at).alias("at"), "own", (own & F.col(WANTED)).alias("live"), "items").alias("cell"))
    cells = placed.groupBy(*key, "b").agg(F.collect_list("cell").alias("cells"))
    return cells.where(F.exists("cells", lambda c: c["live"]))


def _states_of(cells: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For an array of cells: ``(at, own, live, items)`` with the running merge of their items up to each."""
    none = F.filter(cells, lambda c: F.lit(False))
    last = lambda acc: F.coalesce(F.try_element_at(acc, F.lit(-1))["items"], F.array().cast(ITEM_TYPE))
    return F.aggregate(cells, none, lambda acc, c: F.concat(acc, F.array(F.struct(
        c["at"].alias("at"), c["own"].alias("own"), c["live"].alias("live"), merge(c, last(acc)).alias("items")))))


def _items_on_clock(p: DataFrame, cs: CompiledSpecs, wins, pane_ms: int, distinct_values: bool, windows: DataFrame) -> DataFrame:
    """Newest items per active pane and look-back, where item times are the pane clock.

    A pane's items are then newer than all of earlier panes, so one running merge, over blocks
    of the spec's longest look-back and what came in the block before, serves every
    look-back: its items are those of the merge that are in its reach.
    """
    spans: dict[int, int] = {}
    for w in wins:
        spans[w.spec_id] = max(w.window_ms, spans.get(w.spec_id, 0))
    limits = _capacities(cs, set(spans), ("span", spans))
    cells = _blocks(p.join(limits.select("spec_id", "span"), "spec_id"), ["id", "spec_id"], "span", F.col("t"))
    merge = lambda c, so_far: _merged_sorted(c["items"], so_far, F.col("capacity"), distinct_values, y_older=True)
    states = _states_of(F.sort_array("cells"), merge)
    found = cells.join(limits.select("spec_id", "capacity"), "spec_id").select("id", "spec_id", F.inline(F.filter(states, lambda c: c["live"])))
    reach = lambda x: (F.floor(x["ts"] / F.lit(pane_ms)) + 1) * F.lit(pane_ms) > F.col("at") - F.col("window_ms")
    return found.join(windows, "spec_id").select(*ENTITY, "window", F.col("at").alias("t"), "need_ts", F.filter("items", reach).alias("items"))


def _items_in_blocks(p: DataFrame, cs: CompiledSpecs, distinct_values: bool, ids) -> DataFrame:
    """Newest items per active pane and look-back, where items have a time of their own.

    As in :func:`_two_blocks`: panes of the block before are there at ``t + w``, and a look-back is
    the merge of its block's panes up to ``T`` and, backwards, of the moved ones after it.
    """
    cells = _blocks(p, ["id", "spec_id", "window_ms"], "window_ms", F.col("t") + F.col("window_ms"))
    cells = cells.join(_capacities(cs, ids), "spec_id").withColumn("cells", _once(F.sort_array("cells")))
    merge = lambda x, y: _merged_sorted(x, y, F.col("capacity"), distinct_values, y_older=False)
    is_own = lambda c: c["own"] == 1
    heads = _states_of(F.filter("cells", is_own), lambda c, so_far: merge(c["items"], so_far))
    # from the last to the first, a pane before what was moved to its time: that is outside
    tails = _states_of(F.reverse("cells"), lambda c, so_far: F.when(is_own(c), so_far).otherwise(merge(c["items"], so_far)))
    cells = cells.select("id", "spec_id", "window_ms", "capacity", _once(heads).alias("heads"), "cells").select(
        "id", "spec_id", "window_ms", "capacity", "heads", _once(F.reverse(F.filter(tails, is_own))).alias("tails"))
    both = F.zip_with("heads", "tails", lambda h, x: F.struct(h["at"].alias("t"), h["live"].alias("live"), h["items"].alias("head"), x["items"].alias("tail")))
    rows = cells.select("id", "spec_id", "window_ms", "capacity", F.inline(F.filter(both, lambda c: c["live"])))
    return rows.select("id", "spec_id", "window_ms", "t", merge(F.col("head"), F.col("tail")).alias("items"))


def _newest_items(p: DataFrame, pane_ms: int, distinct_values: bool, on_clock: bool) -> DataFrame:
    """Newest items per active pane and look-back, with no more than ``capacity`` of them in any state.

    For look-backs that may have more than ``ARRAY_PANES`` panes.  Time is cut into blocks of the
    look-back's length ``w`` and these into about ``sqrt(w / pane)`` cells.  Running merges go over
    the panes of a cell, and over the cells of a block; a pane's *head* is the merge of both.  Where item times are the
    pane clock, all items of the block before are older, so the look-back is the
    head and that block's last items, as far as they are in reach.  With a time of
    their own, items need the *tail* too: the merge of the panes after ``T - w`` in
    the block before, from running merges in the other direction.

    A task holds one block of one key: the panes of one look-back, whatever the
    key's history; an array holds the items of one cell.
    """
    block = [*ENTITY, "spec_id", "window_ms", "b"]
    k, empty = F.col("capacity"), F.array().cast(ITEM_TYPE)
    placed = p.withColumn("b", _block("t"))
    width = F.ceil(F.sqrt(F.col("window_ms") / F.lit(pane_ms))) * F.lit(pane_ms)
    placed = placed.withColumn("cell", F.floor((F.col("t") - 1 - F.col("b") * F.col("window_ms")) / width)).repartition(*[F.col(c) for c in block])
    cells = _with_running(placed.groupBy(*block, "cell"), k, distinct_values, on_clock)
    total = F.element_at("heads", -1)["items"]
    sums = cells.groupBy(*block).agg(F.array_sort(F.collect_list(F.struct(F.col("cell").alias("t"), total.alias("items"), F.lit(True).alias(WANTED)))).alias("cells"), F.first("capacity").alias("capacity"))
    sums = sums.withColumn("up", _once(_running(F.col("cells"), k, distinct_values)))
    after = []
    if not on_clock:
        sums = sums.withColumn("down", _once(_running(F.reverse("cells"), k, distinct_values)))
        after = [lambda c: F.coalesce(F.try_element_at(F.filter("down", lambda d: d["t"] > c["t"]), F.lit(-1))["items"], empty).alias("after")]
    carry = sums.select(*block, F.inline(F.transform("up", lambda c, i: F.struct(
        c["t"].alias("cell"), F.coalesce(F.get("up", i - 1)["items"], empty).alias("before"), *[f(c) for f in after]))))
    sums = sums.select(*block, "capacity", F.element_at("up", -1)["items"].alias("all"))
    rows = cells.join(unbroadcast(carry), [*block, "cell"])
    rows = rows.select(*block, "capacity", "need_ts", "before", *(["after"] if after else []), _panes_of(on_clock).alias("x"))
    rows = rows.where(F.col("x")[WANTED]) if on_clock else rows
    rows = rows.select("*", F.col("x")[WANTED].alias(WANTED), F.col("x.t").alias("t"), _once(_merged(F.col("x.items"), F.col("before"), k, distinct_values)).alias("head"))
    if after:
        rows = rows.withColumn("tail", _once(_merged(F.col("x.rest"), F.col("after"), k, distinct_values)))
    if on_clock:
        prior = sums.select(*ENTITY, "spec_id", "window_ms", (F.col("b") + 1).alias("b"), F.col("all").alias("prior"))
        rows = rows.join(unbroadcast(prior), block, "left")
        found = _merged(F.col("head"), F.coalesce("prior", empty), k, distinct_values)
        reach = lambda x: (F.floor(x["ts"] / F.lit(pane_ms)) + 1) * F.lit(pane_ms) > F.col("t") - F.col("window_ms")
        return rows.select(*ENTITY, "spec_id", "window_ms", "t", "need_ts", F.filter(found, reach).alias("items"))
    own = rows.select(*block, "capacity", "need_ts", F.col("t").alias("at"), F.lit(1).alias("own"), WANTED, "head", F.lit(None).cast(ITEM_TYPE).alias("tail"))
    moved = rows.select(*ENTITY, "spec_id", "window_ms", (F.col("b") + 1).alias("b"), "capacity", "need_ts", (F.col("t") + F.col("window_ms")).alias("at"),
                        F.lit(0).alias("own"), F.lit(False).alias(WANTED), F.lit(None).cast(ITEM_TYPE).alias("head"), "tail")
    backwards = Window.partitionBy(*block).orderBy(F.desc("at"), F.desc("own")).rowsBetween(Window.unboundedPreceding, 0)
    both = own.unionByName(moved).withColumn("tail", F.last("tail", ignorenulls=True).over(backwards)).where((F.col("own") == 1) & F.col(WANTED))
    return both.select(*ENTITY, "spec_id", "window_ms", F.col("at").alias("t"), "need_ts",
                       _merged(F.col("head"), F.coalesce("tail", empty), k, distinct_values).alias("items"))


# --------------------------------------------------------------------------- latest
def rollup_latest(panes: DataFrame, cs: CompiledSpecs) -> DataFrame:
    """LATEST: the pane's newest value under the bare prefix."""
    params = _params(cs, {r.spec_id for r in cs.rows["specs"] if r.kind == "latest"}).select("feature", "id_type")
    p = panes.where((F.col("kind") == "latest") & _flag(panes)).join(params, ["feature", "id_type"]).withColumn(
        "window", F.lit(None).cast("string"))
    return _emit(p, F.col("feature"), F.lit(None), F.lit(None), F.col("latest_value"), F.lit("string"))


# --------------------------------------------------------------------------- mergeable states
def rollup_states(panes: DataFrame, cs: CompiledSpecs, pane_ms: int, kind: str, count: Callable[[Column], Column]) -> DataFrame:
    """Look-backs of an added kind: the sum over sub keys of ``count`` of the state, as the kind reads it, merged over ``(T - w, T]``.

    Sub keys seen in the look-back but not in the pane at ``T`` are carried over, as groups are (:func:`_seen_pairs`).
    States merge by growing frames in (entity, sub key, block), in linear time; the
    merge of a block's beginning and the end of the one before is the kind's combine again.
    """
    pane = added_kind(kind).pane
    merge = pane.merge or pane.combine
    ids = {r.spec_id for r in cs.rows["specs"] if r.kind == kind}
    if not any(w.spec_id in ids and w.cadence_ms == pane_ms and w.whole is None for w in cs.rows["windows"]):
        return _none(panes)
    params = _params(cs, ids).select("feature", "id_type", "spec_id")
    gp = panes.where(F.col("kind") == kind).join(params, ["feature", "id_type"]).select(
        *ENTITY, "spec_id", "sub_key", F.col("pane_end_ms").alias("t"), pane.read(F.col("state")).alias("state"))
    lengths = _lengths(cs, pane_ms, ids)
    blocked = [*GROUP, "spec_id", "window_ms", "b"]
    ends = gp.join(lengths, "spec_id").withColumn("b", _block("t")).groupBy(*blocked).agg(F.min("t").alias("since"), F.max("t").alias("last"))
    pairs = _seen_pairs(ends, gp.select(*ENTITY, "spec_id", "t").distinct(), lengths).select(*GROUP, "spec_id", "window_ms", "t")
    rows = pairs.join(unbroadcast(gp), [*GROUP, "spec_id", "t"], "left")
    both = State(F.col("state"), merge, lambda head, tail: F.array(head, tail))
    halves = _two_blocks(rows, [*GROUP, "spec_id"], "t", {"state": both}).withColumn("state", F.explode(both.merge(F.col("head_state"), F.col("tail_state"))))
    merged = halves.groupBy(*GROUP, "spec_id", "window_ms", "b", "t").agg(merge("state").alias("state"))
    totals = merged.groupBy(*ENTITY, "spec_id", "window_ms", F.col("t").alias("pane_end_ms")).agg(F.sum(count(F.col("state"))).alias("total"))
    rows = totals.join(_windows(cs, pane_ms).where(F.col("whole").isNull()), ["spec_id", "window_ms"])
    return _emit(rows, F.concat_ws("_", "feature", "window"), F.col("total"), F.lit(None), F.col("total").cast("string"), F.lit("long"))


# --------------------------------------------------------------------------- registry
def _numeric_spec(r) -> bool:
    return r.kind in ("sum", "max", "min") or (r.kind == "count" and r.group_by is None)


# The built-in kinds
for _kind in (
    FeatureKind("numeric", _numeric_spec, lambda p, cs, ms, tz, clock: rollup_numeric(p, cs, ms, tz)),
    FeatureKind("grouped_count", lambda r: r.kind == "count" and r.group_by is not None,
                lambda p, cs, ms, tz, clock: rollup_grouped_count(p, cs, ms, tz)),
    FeatureKind("list", lambda r: r.kind == "list", lambda p, cs, ms, tz, clock: rollup_items(p, cs, ms, "list", clock)),
    FeatureKind("set", lambda r: r.kind == "set", lambda p, cs, ms, tz, clock: rollup_items(p, cs, ms, "set", clock)),
    FeatureKind("latest", lambda r: r.kind == "latest", lambda p, cs, ms, tz, clock: rollup_latest(p, cs)),
):
    register_kind(_kind)


def rollup_all(panes: DataFrame, cs: CompiledSpecs, pane_ms: int, tz: str | None = None,
               clock_field: str = DEFAULT_EVENT_TIME_FIELD) -> DataFrame:
    """All windowed features of one cadence, unioned on the feature schema.

    Only the roll-ups some spec at this cadence needs are planned.  Each
    branch keeps only its own kinds (partition pruning plus a map-side
    broadcast join) before its exchange, so together the branches shuffle
    the pane table once.
    """
    panes = panes.where(F.col("cadence_ms") == pane_ms)
    routed = {r.spec_id for r in cs.rows["routes"] if r.cadence_ms == pane_ms}
    specs = [r for r in cs.rows["specs"] if r.spec_id in routed]
    parts = []
    for kind in KIND_REGISTRY.values():
        if not any(kind.applies(r) for r in specs):
            continue
        if kind.pane is None or WANTED not in panes.columns:
            parts.append(kind.rollup(panes, cs, pane_ms, tz, clock_field))
        else:  # a kind from outside need not know the flag
            at = panes.where((F.col("kind") == kind.name) & F.col(WANTED)).select(*ENTITY, F.col("pane_end_ms").alias("ts")).distinct()
            parts.append(kind.rollup(panes.drop(WANTED), cs, pane_ms, tz, clock_field).join(unbroadcast(at), [*ENTITY, "ts"], "left_semi"))
    if not parts:
        return _none(panes)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
