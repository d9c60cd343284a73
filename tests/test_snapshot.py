"""The incremental snapshot against the full recomputation."""

import random
import re

from tumbleweed.operators.sinks import cell_snapshot
from tumbleweed.operators.snapshot import CELL, CellSnapshot
from tumbleweed.session import scratch_path

SCHEMA = "table string, row_key string, column string, ts bigint, value string, ttl_ms bigint"


def _deltas(n=5, seed=1):
    rng = random.Random(seed)
    return [[("t", f"r{rng.randrange(30)}", rng.choice("abc"), rng.randrange(50), str(rng.randrange(9)), rng.choice([None, 10])) for _ in range(60)]
            for _ in range(n)]


def _rows(df):
    return sorted(df.select(*CELL, "ts", "value", "expires_at_ms").collect(), key=lambda r: tuple(r)[:3])


def test_deltas_equal_the_full_snapshot(spark):
    deltas = _deltas()  # times go back and forth between deltas; equal times occur
    snapshot = CellSnapshot(spark, scratch_path(spark, "snap"), buckets=2, rows_a_bucket=20)  # outgrown at once
    frames = [spark.createDataFrame(d, SCHEMA) for d in deltas]
    for number, delta in enumerate(frames):
        snapshot.apply(delta, number)
    assert snapshot.latest().buckets > 2
    everything = frames[0]
    for f in frames[1:]:
        everything = everything.unionByName(f)
    assert _rows(snapshot.read()) == _rows(cell_snapshot(everything))
    assert _rows(snapshot.read(30)) == _rows(cell_snapshot(everything, 30))
    before = snapshot.latest()
    assert snapshot.apply(frames[2], 4) == before  # a replayed delta
    # another object, as after a restart, goes on with the same base
    again = CellSnapshot(spark, snapshot.root)
    again.apply(spark.createDataFrame([("t", "new", "a", 1, "x", None)], SCHEMA), 5)
    assert again.read().count() == before.rows + 1


def test_only_the_delta_is_shuffled(spark):
    snapshot = CellSnapshot(spark, scratch_path(spark, "snap"), buckets=4)
    first, second = (spark.createDataFrame(d, SCHEMA) for d in _deltas(2))
    version = snapshot.apply(first, 0)
    plan = snapshot.merged(second, version)._jdf.queryExecution().sparkPlan().toString()
    executed = snapshot.merged(second, version)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in executed and "Bucketed: true" in executed, plan
    above_base = re.split(r"FileScan", executed)[0].rsplit("ShuffledHashJoin", 1)[1]
    assert "Exchange" not in above_base and "Sort " not in above_base


def test_expired_cells_go_and_empty_deltas_change_nothing(spark):
    snapshot = CellSnapshot(spark, scratch_path(spark, "snap"), buckets=2)
    snapshot.apply(spark.createDataFrame([("t", "a", "c", 5, "x", 10), ("t", "b", "c", 5, "y", None)], SCHEMA), 0)
    snapshot.apply(spark.createDataFrame([], SCHEMA), 1)
    assert snapshot.read().count() == 2
    snapshot.apply(spark.createDataFrame([], SCHEMA), 2, expired_before_ms=15)
    assert [r.row_key for r in snapshot.read().collect()] == ["b"]


def test_empty_from_the_start(spark):
    snapshot = CellSnapshot(spark, scratch_path(spark, "snap"))
    assert snapshot.read().count() == 0
    snapshot.apply(spark.createDataFrame([], SCHEMA), 0)
    assert snapshot.read().count() == 0 and snapshot.latest().number == 0
