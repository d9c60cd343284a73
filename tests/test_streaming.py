"""Streaming: closed panes equal the batch result; late data; restart with new specs."""

import json
import os
import time
import uuid

import pytest
from feature_helpers import event, make_records, spec
from pyspark.sql import functions as F

from tumbleweed.operators.sinks import cell_snapshot
from tumbleweed.plans.job import FeatureJob
from tumbleweed.session import checkpoint_root
from tumbleweed.sources import folders
from tumbleweed.sources.records import RECORD_SCHEMA
from tumbleweed.sources.specs import specs_from_json
from tumbleweed.streaming import pane_table
from tumbleweed.streaming.job import (AtomBatchWriter, FeatureBatchWriter, SpecSource, StreamPaths, read_features, read_outputs, read_panes,
                                      start_feature_stream)
from tumbleweed.streaming.pane_table import PaneTable

MIN = 60_000


def _write(spark, folder, events):
    rows = [("LIVEROOM", None, json.dumps(e)) for e in events]
    spark.createDataFrame(rows, RECORD_SCHEMA).coalesce(1).write.mode("append").json(folder)
    time.sleep(1.0)   # the file source orders files by modification time


def _run(spark, job, src, paths, **options):
    records = spark.readStream.schema(RECORD_SCHEMA).option("maxFilesPerTrigger", 1).json(src)
    q = start_feature_stream(job, records, paths, delay="1 minute", trigger={"availableNow": True}, **options)
    q.awaitTermination()
    return q


def test_stream_matches_batch_and_drops_late(spark):
    root = f"{checkpoint_root(spark)}/test-stream-{uuid.uuid4().hex[:8]}"
    src = f"{root}/src"
    base = 1_704_067_200_000
    _write(spark, src, [event("u", base + 10_000), event("u", base + 200_000)])   # watermark -> 140s
    _write(spark, src, [event("u", base + 5 * MIN), event("u", base + 10 * MIN)])  # emits pane 1; wm -> 540s
    _write(spark, src, [event("u", base + 20_000), event("u", base + 10 * MIN + 10_000)])  # 20s: pane gone
    job = FeatureJob(specs_from_json(spark, [spec(1, "COUNT", "c", windows=("10m",))]))
    paths = StreamPaths(f"{root}/panes", f"{root}/features", f"{root}/ckpt")
    stream = _run(spark, job, src, paths)
    assert stream.late_events(spark) == (1, 0)
    panes, feats = read_outputs(spark, paths)
    got = sorted((r.pane_end_ms - base, r.cnt) for r in panes.collect())
    assert got == [(MIN, 1), (4 * MIN, 1), (6 * MIN, 1)]     # late row dropped; 11th minute still open
    values = sorted((r.ts - base, r.value_long) for r in feats.collect())
    assert values == [(MIN, 1), (4 * MIN, 2), (6 * MIN, 3)]

    # Restart on the same checkpoint with an extra spec; the open pane is kept
    job2 = FeatureJob(specs_from_json(spark, [spec(1, "COUNT", "c", windows=("10m",)),
                                              spec(2, "SUM", "s", windows=("10m",), field="ext.x",
                                                   fieldType="long")]))
    _write(spark, src, [event("u", base + 10 * MIN + 5_000, x=4), event("u", base + 30 * MIN)])
    _run(spark, job2, src, paths)
    panes, feats = read_outputs(spark, paths)
    c11 = [r.cnt for r in panes.collect() if r.pane_end_ms - base == 11 * MIN and r.feature == "c"]
    assert c11 == [3]
    by_name = {(r.ts - base, r.feature_name): r.value_long for r in feats.collect()}
    assert by_name[(11 * MIN, "s_10m")] == 4
    assert by_name[(11 * MIN, "c_10m")] == 5      # panes at 4, 6 and 11 minutes


def _folder(name):
    return lambda spark: f"{checkpoint_root(spark)}/test-{name}-{uuid.uuid4().hex[:8]}"


def _paths(root):
    return StreamPaths(f"{root}/panes", f"{root}/features", f"{root}/ckpt", f"{root}/sinks")


def _batches(spark, writer, *batches):
    for n, events in enumerate(batches):
        writer(make_records(spark, events), n)


def _values(spark, paths, *columns):
    return sorted(tuple(r[c] for c in ("feature_name", "ts", *columns)) for r in read_features(spark, paths).collect())


def test_specs_change_while_the_query_runs(spark):
    root = _folder("change")(spark)
    table = {"specs": [spec(1, "COUNT", "c"), spec(2, "COUNT", "d")]}
    source = SpecSource(lambda: specs_from_json(spark, table["specs"]), every_s=0)
    paths = _paths(root)
    writer = FeatureBatchWriter(source, paths, delay=0)
    writer(make_records(spark, [event("u", 10_000)]), 0)
    writer(make_records(spark, [event("u", 70_000)]), 1)
    assert source.compiled == 1
    table["specs"] = [spec(1, "COUNT", "c"), spec(3, "SUM", "s", field="ext.x", fieldType="long")]  # one deleted, one new; no updateTime tells
    writer(make_records(spark, [event("u", 130_000, x=5)]), 2)
    writer(make_records(spark, [event("u", 190_000, x=2), event("u", 250_000, x=1)]), 3)
    assert source.compiled == 2
    assert _values(spark, paths, "value_long") == [
        ("c_10m", MIN, 1), ("c_10m", 2 * MIN, 2), ("c_10m", 3 * MIN, 3), ("c_10m", 4 * MIN, 4),
        ("d_10m", MIN, 1), ("s_10m", 3 * MIN, 5), ("s_10m", 4 * MIN, 7)]


def test_late_events_correct_what_looks_back_on_them(spark):
    specs = [spec(1, "COUNT", "c", windows=("3m",)), spec(2, "MIN", "m", windows=("3m",), field="ext.x", fieldType="long"),
             spec(3, "SET", "s", windows=("3m",), field="ext.v", capacity=2), spec(4, "COUNT", "h", windows=("2h",), delay="1h")]
    specs[1]["sinks"] = [{"type": "cells", "fields": {"m_3m": {"table": "t", "ttl": 0, "rename": "m"}}}]
    job = FeatureJob(specs_from_json(spark, specs))
    minutes = [event("u", i * MIN + 1_000, x=50 - i, v=f"v{i}") for i in range(9)]
    late = [event("u", 2 * MIN + 30_000, x=1, v="late"), event("w", 1_000, x=7, v="w"), event("u", 30_000, x=9, v="old")]
    early, tail = minutes[:7], minutes[7:] + [event("u", 130 * MIN, x=3, v="z")]
    merged, dropped = (_paths(_folder("late")(spark)) for _ in range(2))
    # 6 minutes are closed when the late ones come; the last of them, and the new key, are beyond 5 minutes
    _batches(spark, FeatureBatchWriter(job, merged, delay=0, lateness="5m"), early, late, tail)
    _batches(spark, FeatureBatchWriter(job, dropped, delay=0), early, late, tail)
    version = PaneTable(spark, merged.panes).latest()
    assert (version.events, version.late, version.applied) == (13, 3, 1)
    assert PaneTable(spark, dropped.panes).latest().late == 3 and PaneTable(spark, dropped.panes).latest().applied == 0
    side = {(r.uid, r.event_ms, r.applied) for r in spark.read.parquet(f"{merged.panes}/late").collect()}
    assert side == {("u", 2 * MIN + 30_000, True), ("w", 1_000, False), ("u", 30_000, False)}
    columns = ("value_long", "value_text")
    batch = lambda events: sorted((r.feature_name, r.ts, r.value_long, r.value_text) for c in job.compiled.cadences()
                                  for r in FeatureJob(job.specs, pane_ms=c, materialize=False).windowed_features(make_records(spark, events)).collect()
                                  if r.ts <= 130 * MIN)
    assert _values(spark, merged, *columns) == batch(early + late[:1] + tail)
    assert _values(spark, dropped, *columns) == batch(early + tail)
    # the corrected cell is the newest version of its row
    cells = spark.read.parquet(f"{merged.sinks}/cells")
    newest = {r.ts: r.value for r in cell_snapshot(cells.where(F.col("ts") <= 5 * MIN), version="batch_id").collect()}
    assert newest == {5 * MIN: "1"}


def test_table_stays_small_and_whole_over_many_batches(spark, monkeypatch):
    monkeypatch.setattr(pane_table, "FAN_IN", 3)
    monkeypatch.setattr(FeatureBatchWriter, "_horizon", lambda self, job: 600_000)
    job = FeatureJob(specs_from_json(spark, [spec(1, "COUNT", "c", windows=("10m",)), spec(3, "COUNT", "s", windows=("1m",), delay="10s")]))
    paths = _paths(_folder("compact")(spark))
    writer = FeatureBatchWriter(job, paths, delay="30 seconds", lateness="1m")
    events = [event("u", i * 40_000 + 500) for i in range(60)]
    late = {n: event("u", 5 * n * 40_000 - 100_000) for n in (3, 7)}
    listed = []
    for n in range(12):
        writer(make_records(spark, events[5 * n:5 * n + 5] + ([late[n]] if n in late else [])), n)
        version = PaneTable(spark, paths.panes).latest()
        listed.append(len(version.panes) + len(version.partials))
    assert (version.late, version.applied) == (2, 2)
    assert max(listed) <= 2 * 2 * 3 and max(f.level for f in version.panes) > 0
    assert len(folders.names(spark, f"{paths.panes}/versions")) <= pane_table.KEEP
    kept = len(folders.names(spark, f"{paths.panes}/panes")) + len(folders.names(spark, f"{paths.panes}/partials"))
    assert kept <= listed[-1] + len(version.garbage)
    assert folders.file_count(spark, f"{paths.panes}/panes") < 100
    assert read_panes(spark, paths).agg(F.min("pane_end_ms")).first()[0] > version.watermark - 2 * 3_600_000
    got = _values(spark, paths, "value_long")
    for cadence in job.compiled.cadences():
        want = FeatureJob(job.specs, pane_ms=cadence, materialize=False).windowed_features(make_records(spark, events + list(late.values())))
        want = sorted((r.feature_name, r.ts, r.value_long) for r in want.collect() if r.ts <= version.watermark)
        assert [v for v in got if v[0] == want[0][0]] == want


def test_a_table_of_another_checkpoint_is_refused(spark):
    paths = _paths(_folder("order")(spark))
    job = FeatureJob(specs_from_json(spark, [spec(1, "COUNT", "c")]))
    _batches(spark, FeatureBatchWriter(job, paths), [event("u", 1)], [event("u", 2)])
    with pytest.raises(ValueError, match="another checkpoint"):
        FeatureBatchWriter(job, paths)(make_records(spark, [event("u", 3)]), 0)


def test_batches_without_events_or_windowed_specs(spark):
    paths = _paths(_folder("empty")(spark))
    job = FeatureJob(specs_from_json(spark, [spec(1, "COUNT", "c"), {**spec(2, "COUNT", "bad"), "windows": []}]))
    none = FeatureJob(specs_from_json(spark, [spec(1, "MEDIAN", "c")]))
    _batches(spark, FeatureBatchWriter(lambda n: none if n == 1 else job, paths, delay=0), [], [event("u", 1)], [event("u", 2), {"uid": "u"}, "not json"], [event("u", 2 * MIN)])
    assert PaneTable(spark, paths.panes).latest().events == 3
    assert _values(spark, paths, "value_long") == [("c_10m", MIN, 1)]


def test_replayed_batches_leave_nothing_twice(spark):
    """Every output of a batch is replaced when the batch is replayed (T5); sinks are written by type."""
    root = f"{checkpoint_root(spark)}/test-replay-{uuid.uuid4().hex[:8]}"
    specs = [spec(1, "COUNT", "c", windows=("10m",)), spec(2, "SET", "s", windows=("10m",), field="ext.v", capacity=2),
             {**spec(3, "ATOM", "a", fields=[{"sourceField": "ext.v", "featureName": "v"}]), "windows": []}]
    specs[0]["sinks"] = [{"type": "hbase", "fields": {"c_10m": {"table": "t", "ttl": 60, "rename": "n"}}},
                         {"type": "unheard-of", "fields": {"c_10m": {"table": "t", "ttl": 60, "rename": "n"}}}]
    specs[2]["sinks"] = [{"type": "cells", "fields": {"a_v": {"table": "t", "ttl": 0, "rename": "v"}}}]
    job = FeatureJob(specs_from_json(spark, specs))
    paths = StreamPaths(f"{root}/panes", f"{root}/features", f"{root}/ckpt", f"{root}/sinks")
    batches = [make_records(spark, [event("u", 10_000, v="x"), event("w", 20_000, v="y")]), make_records(spark, [event("u", 70_000, v="z")])]
    batches.append(make_records(spark, [event("x", 10 * MIN, v="q")]))
    for n in (0, 0, 1, 1, 2):
        # a writer of its own each time, as after a restart
        if PaneTable(spark, paths.panes).latest().number < n:
            _fail_before_commit(FeatureBatchWriter(job, paths, delay=0), batches[n], n)
        FeatureBatchWriter(job, paths, delay=0)(batches[n], n)
        AtomBatchWriter(job, paths)(batches[n], n)
    _, feats = read_outputs(spark, paths)
    rows = sorted((r.id, r.feature_name, r.ts, r.value_text) for r in feats.collect())
    assert rows == [("u", "a_v", 10_000, "x"), ("u", "a_v", 70_000, "z"), ("u", "c_10m", MIN, "1"), ("u", "c_10m", 2 * MIN, "2"),
                    ("u", "s_10m", MIN, '["x"]'), ("u", "s_10m", 2 * MIN, '["z","x"]'),
                    ("w", "a_v", 20_000, "y"), ("w", "c_10m", MIN, "1"), ("w", "s_10m", MIN, '["y"]'),
                    ("x", "a_v", 10 * MIN, "q")]
    cells = sorted((r.row_key, r.column, r.ts, r.value) for r in spark.read.parquet(f"{root}/sinks/cells").collect())
    assert cells == [("uu", "n", MIN, "1"), ("uu", "n", 2 * MIN, "2"), ("uu", "v", 10_000, "x"), ("uu", "v", 70_000, "z"),
                     ("ww", "n", MIN, "1"), ("ww", "v", 20_000, "y"), ("xx", "v", 10 * MIN, "q")]
    assert spark.read.parquet(f"{root}/sinks/messages").count() == 7


def _fail_before_commit(writer, records, batch_id):
    """Run a batch up to its last step, which fails."""
    def fail(self, version):
        raise OSError("gone")

    with pytest.MonkeyPatch.context() as patch, pytest.raises(OSError, match="gone"):
        patch.setattr(PaneTable, "commit", fail)
        writer(records, batch_id)
