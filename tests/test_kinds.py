"""A kind registered from outside: batch, stream, validation."""

import random

import pytest
from feature_helpers import event, features, make_records, spec

from extensions.distinct import DISTINCT
from tumbleweed.operators.panes import combine_partials, pane_partials
from tumbleweed.plans.compile import compile_specs
from tumbleweed.plans.job import FeatureJob
from tumbleweed.plans.kinds import FeatureKind, KIND_REGISTRY, register_kind
from tumbleweed.session import scratch_path
from tumbleweed.sources.records import RECORD_SCHEMA
from tumbleweed.sources.specs import specs_from_json
from tumbleweed.streaming.job import StreamPaths, read_features, start_feature_stream

MIN = 60_000
WINDOWS = {"2m": 2 * MIN, "10m": 10 * MIN}


def _events(n=150, seed=5):
    rng = random.Random(seed)
    values = [-(1 << 63), -40_000, -32_768, -32_767, -1, 0, 1, 32_767, 32_768, 32_769, 70_000, (1 << 63) - 1]
    out = [event(rng.choice("aab"), rng.randrange(40 * MIN), k=rng.choice(values)) for _ in range(n)]
    return out + [event("a", 5, k="no number"), event("c", 5, k="x"), event("a", 7)]


def _brute(events, upto=None):
    want = {}
    rows = [(e["uid"], (e["ext"]["eventTime"] // MIN + 1) * MIN, e["ext"]["k"]) for e in events if isinstance(e["ext"].get("k"), int)]
    for uid, t in {(u, t) for u, t, _ in rows}:
        for name, w in WINDOWS.items():
            if upto is None or t <= upto:
                want[uid, f"d_{name}", t] = len({k for u, s, k in rows if u == uid and t - w < s <= t})
    return want


def _got(df):
    return {(r.id, r.feature_name, r.ts): r.value_long for r in df.where("feature = 'd'").collect()}


SPEC = spec(1, "DISTINCT", "d", windows=tuple(WINDOWS), field="ext.k", fieldType="long")


def test_distinct_equals_brute_force(spark):
    events = _events()
    df = features(spark, [SPEC, spec(2, "COUNT", "n")], events)
    assert _got(df) == _brute(events)
    assert df.where("feature = 'n'").count() > 0  # beside the built-in kinds


def test_states_combine(spark):
    """Partials of parts of the events, combined, count as those of all events."""
    events = _events()
    job = FeatureJob(specs_from_json(spark, [SPEC, spec(2, "COUNT", "n")]))
    routed = lambda es: job.routed(make_records(spark, es))
    parts = pane_partials(routed(events[:70]), {"distinct", "count"}).unionByName(pane_partials(routed(events[70:]), {"distinct", "count"}))
    key = lambda df: sorted((r.id, r.feature, r.sub_key, r.pane_end_ms, r.cnt, bytes(r.state or b"")) for r in df.collect())
    assert key(combine_partials(parts, {"distinct", "count"})) == key(pane_partials(routed(events), {"distinct", "count"}))


def test_distinct_in_the_stream(spark):
    events = sorted(_events(), key=lambda e: e["ext"]["eventTime"])
    root = scratch_path(spark, "kinds")
    for part in (events[:80], events[80:]):
        spark.createDataFrame(make_records(spark, part).collect(), RECORD_SCHEMA).coalesce(1).write.mode("append").json(f"{root}/src")
    job = FeatureJob(specs_from_json(spark, [SPEC, spec(2, "COUNT", "n")]))
    paths = StreamPaths(f"{root}/panes", f"{root}/features", f"{root}/checkpoint")
    records = spark.readStream.schema(RECORD_SCHEMA).option("maxFilesPerTrigger", 1).json(f"{root}/src")
    start_feature_stream(job, records, paths, delay="1 minute", lateness="1h", trigger={"availableNow": True}).awaitTermination()
    newest = max(e["ext"]["eventTime"] for e in events)
    assert _got(read_features(spark, paths)) == _brute(events, newest - MIN)


def test_an_invalid_spec_of_the_kind_is_reported(spark):
    bad = [spec(3, "DISTINCT", "x", field="ext.k", fieldType="double"), spec(4, "DISTINCT", "y", windows=("today",), field="ext.k", fieldType="long"),
           spec(5, "DISTINCT", "z", fieldType="long"), spec(6, "NUMERIC", "q", field="ext.k"), spec(7, "DISTINCT", "w", windows=("10x",), field="ext.k", fieldType="long")]
    got = {r.spec_id: r.error for r in compile_specs(specs_from_json(spark, [SPEC, *bad])).rows["validation"]}
    assert got == {3: "DISTINCT needs fieldType long", 4: "DISTINCT has no whole windows", 5: "missing aggConfig.field",
                   6: "unknown kind: numeric", 7: "bad window: 10x"}


def test_built_in_kinds_stay(spark):
    with pytest.raises(ValueError):
        register_kind(FeatureKind("list", lambda s: True, lambda *a: None, pane=DISTINCT.pane))
    assert KIND_REGISTRY["list"].pane is None
