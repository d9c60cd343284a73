"""What feature jobs spend their time on: idle cores, repeated sorts, joins of what is at hand."""

import contextlib
import datetime
import io
import random

from feature_helpers import event, make_records, spec

from tumbleweed.operators.panes import PANE_COLUMNS, PANE_SCHEMA, PARTIAL_SCHEMA, pane_partials, retention_ms
from tumbleweed.operators.rollup import WANTED, _lengths, rollup_all
from tumbleweed.operators.sinks import cell_snapshot, feature_messages, message_batches
from tumbleweed.plans.job import FeatureJob
from tumbleweed.session import scratch_path
from tumbleweed.sources.records import RECORD_SCHEMA
from tumbleweed.sources.specs import specs_from_json
from tumbleweed.sources.standin import event_records
from tumbleweed.streaming import job as streaming
from tumbleweed.streaming.pane_table import newest_panes

MIN = 60_000

CELLS = "table string, row_key string, column string, ts bigint, value string, ttl_ms bigint, id string, id_type string, biz_type string"


def _plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_all_cores_parse_a_small_file(spark):
    """a table of one small file is parsed by as many tasks as there are cores."""
    root = scratch_path(spark, "one-file")
    rows = [(i, datetime.datetime(2024, 1, 1), i, "view", 1.0, '{"k": 1}') for i in range(50)]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    events.coalesce(1).write.parquet(f"{root}/events.parquet")
    records = event_records(spark, root)
    assert records.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert sorted(int(r.key) for r in records.collect()) == list(range(50))


def _cells(n=300, seed=5):
    rng = random.Random(seed)
    return [("t", f"r{i}", rng.choice("ab"), rng.choice([*range(6_000), None]), rng.choice(["1", "2", None]), None, rng.choice("xy"), "uid", rng.choice(["g", "h", None]))
            for i in range(n)]


def test_message_batches_equal_a_walk(spark):
    """one aggregate makes the messages of a batch, whatever repeats in it."""
    cells, order = _cells(), lambda v: (v is not None, v or 0)
    walk = {}
    for entity in sorted({(c[6], None if c[3] is None else c[3] // 1_000) for c in cells}, key=str):
        own = [c for c in cells if (c[6], None if c[3] is None else c[3] // 1_000) == entity]
        own.sort(key=lambda c: (order(c[3]), c[2], (c[4] is not None, c[4] or "")))
        for i, c in enumerate(own):
            if c[8] is not None:
                walk.setdefault((*entity, i // 4, c[8]), {})[c[2]] = c[4]
    out = message_batches(spark.createDataFrame(cells, CELLS), max_rows=4)
    got = {(r.id, None if r.ts is None else r.ts // 1_000, r.batch, r.biz_type): r.kv for r in out.collect()}
    assert got == walk
    assert "SortAggregate" not in _plan(out)


def test_snapshot_sorts_by_the_row_first(spark):
    """the few tables and columns of all cells don't lead the sorts."""
    plan = _plan(cell_snapshot(spark.createDataFrame(_cells(), CELLS)))
    assert "Sort [row_key#" in plan and "Sort [table#" not in plan


def test_whole_days_go_with_the_look_backs(spark):
    """Today, yesterday and look-backs come from one exchange of the panes."""
    job = FeatureJob(specs_from_json(spark, [spec(1, "SUM", "s", windows=("10m", "3h", "today", "yesterday"), field="ext.k", fieldType="long")]))
    path = scratch_path(spark, "panes")
    spark.createDataFrame([], PANE_SCHEMA).write.parquet(path)
    plan = _plan(rollup_all(spark.read.schema(PANE_SCHEMA).parquet(path), job.compiled, MIN))
    assert plan.count("Exchange hashpartitioning") == 1


def test_features_are_made_at_wanted_panes_only(spark):
    """What is only looked back on is left out, and changes nothing else."""
    rng = random.Random(8)
    events = [event(rng.choice("ab"), rng.randrange(50 * 60) * MIN, k=rng.randrange(9), g=rng.choice("xy")) for _ in range(120)]
    whole = ("10m", "24h", "today", "yesterday")
    job = FeatureJob(specs_from_json(spark, [
        spec(1, "SUM", "s", windows=whole, field="ext.k", fieldType="long"), spec(2, "COUNT", "c", windows=whole), spec(3, "COUNT", "g", windows=whole, groupByField="ext.g"),
        spec(4, "LIST", "l", windows=("24h",), field="ext.k", capacity=3), spec(5, "SET", "t", windows=("24h",), field="ext.g", capacity=2, eventTimeField="ext.k"),
        spec(6, "LATEST", "z", field="ext.k"), spec(7, "SET", "w", windows=("7d",), field="ext.g", capacity=2, eventTimeField="ext.k")]), tz="UTC")
    panes = job.panes(make_records(spark, events)).localCheckpoint()
    cut = 26 * 60 * MIN
    rows = lambda df: sorted(map(str, df.collect()))
    every = rollup_all(panes, job.compiled, MIN, "UTC")
    flagged = panes.withColumn(WANTED, panes.pane_end_ms > cut)
    assert rows(rollup_all(flagged, job.compiled, MIN, "UTC")) == rows(every.where(every.ts > cut))


def test_stream_joins_no_features_afterwards(spark, monkeypatch):
    """A batch's panes tell which features it makes; no join of all features."""
    plans = []
    write = streaming.write_features
    monkeypatch.setattr(streaming, "write_features", lambda features, *rest: (plans.append(_plan(features)), write(features, *rest)))
    root = scratch_path(spark, "flags")
    events = [event("u", m * MIN, k=m) for m in range(60)]
    spark.createDataFrame(make_records(spark, events).collect(), RECORD_SCHEMA).coalesce(1).write.json(f"{root}/src")
    job = FeatureJob(specs_from_json(spark, [spec(1, "COUNT", "n", windows=("10m", "today"))]))
    paths = streaming.StreamPaths(f"{root}/panes", f"{root}/features", f"{root}/checkpoint")
    streaming.start_feature_stream(job, spark.readStream.schema(RECORD_SCHEMA).json(f"{root}/src"), paths, trigger={"availableNow": True}).awaitTermination()
    assert len(plans) == 1 and not [line for line in plans[0].split("\n") if "LeftSemi" in line and "ts#" in line]


def test_newest_panes_sort_once(spark):
    """F8: corrected panes replace earlier ones without an aggregate of texts, which sorts before and after the exchange."""
    rows = spark.createDataFrame([("u", "uid", "f", "count", "", MIN, MIN * t, batch, None, None, None, None, None, None, batch)
                                  for t in (1, 2) for batch in (1, 2, 3) if (t, batch) != (2, 3)], PANE_SCHEMA + ", batch_id bigint")
    newest = newest_panes(rows)
    plan = _plan(newest)
    assert "SortAggregate" not in plan and plan.count("Sort [") == 1
    assert {(r.pane_end_ms, r.cnt) for r in newest.collect()} == {(MIN, 3), (2 * MIN, 2)}
    assert newest.columns == [*PANE_COLUMNS, "batch_id"]


def _recent_panes_plan(spark, *specs) -> str:
    job = FeatureJob(specs_from_json(spark, list(specs)))
    path = scratch_path(spark, "panes")
    spark.createDataFrame([], PANE_SCHEMA).write.parquet(path)
    return _plan(rollup_all(spark.read.schema(PANE_SCHEMA).parquet(path), job.compiled, MIN))


def test_recent_items_take_one_shuffle_for_all_look_backs(spark):
    """Items on the pane clock are merged once for every look-back, without a join of blocks."""
    plan = _recent_panes_plan(spark, spec(1, "LIST", "l", windows=("3h", "24h"), field="ext.k", capacity=3))
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_recent_items_of_their_own_time_take_one_shuffle(spark):
    """both parts of a look-back come from one exchange, and running merges are made once."""
    plan = _recent_panes_plan(spark, spec(1, "SET", "s", windows=("3h", "24h"), field="ext.g", capacity=2, eventTimeField="ext.k"))
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan


def test_events_are_fanned_out_to_routed_id_types_only(spark):
    """No rows for id types that no spec is routed by."""
    events = [event("u", MIN, targetUid="t", anchorUid="a")]
    fanned = lambda *ids: sorted(r.id for r in FeatureJob(specs_from_json(spark, [
        spec(i, "COUNT", f"c{i}", id_type=t) for i, t in enumerate(ids)])).fanned(make_records(spark, events)).collect())
    assert fanned("uid") == ["u"] and fanned("uid", "anchorUid") == ["a", "u"] and fanned("uid", "targetUid", "anchorUid") == ["a", "t", "u"]


def test_partials_of_one_batch_are_not_combined_again(spark, monkeypatch):
    """Only panes that an earlier batch has partials of are combined, whatever its base cadence was."""
    combined = []
    combine = streaming.combine_partials
    monkeypatch.setattr(streaming, "combine_partials", lambda rows, kinds: (combined.append({r.pane_end_ms for r in rows.collect()}), combine(rows, kinds))[1])
    root = scratch_path(spark, "lone")
    paths = streaming.StreamPaths(f"{root}/panes", f"{root}/features", f"{root}/checkpoint")
    item = lambda delay: FeatureJob(specs_from_json(spark, [spec(1, "LIST", "l", field="ext.k", capacity=9, delay=delay)]), pane_ms=1000 if delay == "1s" else MIN)
    writer = streaming.FeatureBatchWriter(lambda batch: item("1s" if batch == 0 else "1m"), paths, delay=5_000)
    writer(make_records(spark, [event("u", t, k=t) for t in (1_000, 61_000, 64_500)]), 0)
    assert not combined
    writer(make_records(spark, [event("u", t, k=t) for t in (65_500, 125_000, 200_000)]), 1)
    assert combined == [{MIN, 2 * MIN}]
    items = {r.pane_end_ms: sorted(i.value for i in r["items"]) for r in streaming.read_panes(spark, paths).where("cadence_ms = 60000").collect()}
    assert items == {MIN: ["1000"], 2 * MIN: ["61000", "64500", "65500"], 3 * MIN: ["125000"]}


def test_records_are_made_once(spark, tmp_path):
    """Times are read from what was staged, so no event's JSON is made a second time."""
    made = spark.sparkContext.accumulator(0)

    def count(rows):
        for r in rows:
            made.add(1)
            yield r

    rows = [("T", None, f'{{"ext":{{"eventTime":{t}}}}}') for t in range(40)] + [("T", None, "{}")]
    records = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).mapPartitions(count), RECORD_SCHEMA)
    assert streaming.write_record_files(spark, records, f"{tmp_path}/src") == 1
    assert made.value == 41 and spark.read.schema(RECORD_SCHEMA).json(f"{tmp_path}/src").count() == 41


def test_partials_of_one_branch_are_not_kept(spark, monkeypatch):
    """the partials are cached only where both numeric and item panes are made of them."""
    from pyspark.sql.classic.dataframe import DataFrame

    kept = []
    persist = DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda df, *level: (kept.append(df), persist(df, *level))[1])
    item, number = spec(1, "SET", "s", field="ext.g", capacity=2, eventTimeField="ext.k"), spec(2, "COUNT", "c")
    made = lambda *specs: FeatureJob(specs_from_json(spark, list(specs))).materialized_panes(make_records(spark, [event("u", MIN, g="x", k=3)])).count()
    assert made(item) == 1 and made(number) == 1 and not kept
    assert made(item, number) == 2 and len(kept) == 1


def test_messages_sort_and_pair_without_lambdas(spark):
    """a message's rows are sorted by a built-in order and become its map by columns, not element by element."""
    cells = spark.createDataFrame(_cells(), CELLS)
    batches, singles = _plan(message_batches(cells, max_rows=4)), _plan(feature_messages(cells))
    assert "array_sort(" not in batches and "map_from_entries" not in batches and "array_sort(" not in singles
    kept = {(r.id, r.ts, r.biz_type): r.kv for r in feature_messages(cells).collect()}
    want = {}
    for c in _cells():
        if c[8] is not None:
            kv = want.setdefault((c[6], c[3], c[8]), {})
            kv[c[2]] = max(filter(None, (kv.get(c[2]), c[4])), default=None)
    assert kept == want


def test_partials_hold_what_their_kinds_fill(spark):
    """Aggregates of kinds that no spec has are left out, and a row's values are looked up once."""
    rng = random.Random(4)
    events = [event(rng.choice("ab"), rng.randrange(5 * MIN), k=rng.choice([1, 2, "x", None]), g=rng.choice(["x", "y", None])) for _ in range(80)]
    specs = [spec(1, "COUNT", "n"), spec(2, "SUM", "s", field="ext.k", fieldType="long"), spec(3, "SET", "t", field="ext.g", capacity=2),
             spec(4, "COUNT", "c", groupByField="ext.g"), spec(5, "LIST", "l", field="ext.k", capacity=2), spec(6, "MAX", "m", field="ext.k", fieldType="double")]
    rows = lambda df: sorted(map(str, df.collect()))
    for chosen in (specs[:2], specs[1:4], specs):
        job = FeatureJob(specs_from_json(spark, chosen))
        routed = job.routed(make_records(spark, events))
        some = pane_partials(routed, job.compiled.kinds_at(MIN))
        assert some.columns == [c.split()[0] for c in PARTIAL_SCHEMA.split(", ")]
        assert rows(some) == rows(pane_partials(routed))
    job = FeatureJob(specs_from_json(spark, specs[:3]))
    plan = _plan(pane_partials(job.routed(make_records(spark, events)), job.compiled.kinds_at(MIN)))
    assert "_max_" not in plan and "min(" not in plan
    assert not [line for line in plan.split("\n") if "Filter" in line and "ext." in line]


def test_today_alone_needs_no_day_before(spark):
    """Panes go to the next day's block only where something looks back on them from there."""
    rng = random.Random(6)
    events = [event(rng.choice("ab"), rng.randrange(70 * 60) * MIN, k=rng.randrange(9)) for _ in range(90)]
    job = lambda *windows: FeatureJob(specs_from_json(spark, [spec(1, "SUM", "s", windows=windows, field="ext.k", fieldType="long")]), tz="UTC")
    moves = lambda j: {r.window_ms: r.moves for r in _lengths(j.compiled, MIN, {1}, whole_days=True).collect()}
    alone, both = job("10m", "today"), job("10m", "today", "yesterday")
    assert moves(alone) == {600_000: True, -1: False} and moves(both) == {600_000: True, -1: True}
    made = lambda j: j.windowed_features(make_records(spark, events))
    rows = lambda df: sorted(map(str, df.collect()))
    every = made(both)
    assert rows(made(alone)) == rows(every.where(every.window != "yesterday"))


def _of_plan(spark, *specs, **job):
    made = FeatureJob(specs_from_json(spark, list(specs)), tz="UTC", **job)
    path = scratch_path(spark, "panes")
    spark.createDataFrame([], PANE_SCHEMA).write.parquet(path)
    return _plan(rollup_all(spark.read.schema(PANE_SCHEMA).parquet(path), made.compiled, MIN))


def test_shuffle_does_not_grow_with_the_look_backs(spark):
    """a pane is shuffled by its span of time, and goes to the blocks of each look-back after that."""
    plan = _of_plan(spark, spec(1, "SUM", "s", windows=("10m", "3h", "24h", "today", "yesterday"), field="ext.k", fieldType="long"))
    dealt = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert len(dealt) == 1 and "part#" in dealt[0] and "window_ms#" not in dealt[0]


def test_look_backs_of_any_length_meet_at_the_ends_of_spans(spark):
    """lengths that don't divide one another, and panes at and beside the ends of blocks and spans, equal a walk."""
    rng = random.Random(8)
    lengths = {"7m": 7, "10m": 10, "33m": 33}
    minutes = sorted({0, 65, 66, 67, 131, 132, 133, *[rng.randrange(300) for _ in range(120)]})
    events = [event("a", m * MIN, k=rng.randrange(50)) for m in minutes]
    got = FeatureJob(specs_from_json(spark, [spec(1, "SUM", "s", windows=tuple(lengths), field="ext.k", fieldType="long"),
                                             spec(2, "MAX", "m", windows=tuple(lengths), field="ext.k", fieldType="long")]), tz="UTC").windowed_features(make_records(spark, events))
    found = {(r.feature, r.window, r.ts // MIN): r.value_long for r in got.collect()}
    at = {e["ext"]["eventTime"] // MIN + 1: e["ext"]["k"] for e in events}
    want = {(f, name, t): agg(at[x] for x in at if t - w < x <= t) for t in at for name, w in lengths.items() for f, agg in (("s", sum), ("m", max))}
    assert found == want


def test_groups_of_all_windows_share_their_passes(spark):
    """look-backs and whole days of grouped counts come from the same presence, pairs and running totals."""
    plan = _of_plan(spark, spec(1, "COUNT", "g", windows=("10m", "3h", "today", "yesterday"), groupByField="ext.v"))
    assert plan.count("Exchange hashpartitioning") <= 5


def test_retention_is_a_table_of_the_driver(spark):
    """how long panes are kept takes no shuffle and no join of spec tables, for each batch anew."""
    job = FeatureJob(specs_from_json(spark, [spec(1, "COUNT", "a", windows=("10m", "3h")), spec(2, "COUNT", "b", windows=("yesterday",)), spec(3, "COUNT", "c", windows=("today",)),
                                             spec(4, "COUNT", "d", windows=("1m",))]))
    kept = retention_ms(job.compiled)
    assert {r.feature: r.retention_ms for r in kept.collect()} == {"a": 180 * MIN, "b": 2880 * MIN, "c": 1440 * MIN, "d": 60 * MIN}
    assert "Exchange" not in _plan(kept) and "Join" not in _plan(kept)


def test_written_panes_leave_no_shuffle_files(spark):
    """the shuffles of the pane table are gone when it is written, before the roll-ups make theirs."""
    left = lambda: sum(1 for b in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().toList().mkString("\n").split("\n") if "shuffle_" in b)
    job = FeatureJob(specs_from_json(spark, [spec(2, "LIST", "l", field="ext.k", capacity=2)]))
    records = make_records(spark, [event(f"u{i}", i * MIN, k=i) for i in range(50)])
    before = left()
    panes = job.materialized_panes(records)
    assert left() <= before
    assert panes.count() == 50
