"""What must not grow with the data: broadcasts of look-back joins, shuffles of a look-back, states of distinct counts."""

import contextlib
import io
import random

from feature_helpers import event, make_records, spec

from extensions.distinct import DISTINCT  # noqa: F401  (registers the kind)
from tumbleweed.operators.panes import PANE_SCHEMA, pane_partials
from tumbleweed.operators.rollup import rollup_all
from tumbleweed.operators.sessions import build_session_panes
from tumbleweed.plans.job import FeatureJob
from tumbleweed.session import METHOD_LIMIT, compiled_code_only, scratch_path
from tumbleweed.sources.records import RECORD_SCHEMA
from tumbleweed.sources.specs import specs_from_json
from tumbleweed.streaming import job as streaming

MIN = 60_000


def _plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def _events(n=200, seed=3):
    rng = random.Random(seed)
    return [event(rng.choice("abc"), rng.randrange(90 * MIN), event_type="pay", k=rng.randrange(100)) for _ in range(n)]


def test_stream_broadcasts_no_panes(spark, monkeypatch):
    """Tables that grow with the batch are not put on the driver, however small their files are."""
    plans = []
    write = streaming.write_features
    monkeypatch.setattr(streaming, "write_features", lambda features, *rest: (plans.append(_plan(features)), write(features, *rest)))
    root = scratch_path(spark, "broadcasts")
    spark.createDataFrame(make_records(spark, _events()).collect(), RECORD_SCHEMA).coalesce(1).write.json(f"{root}/src")
    job = FeatureJob(specs_from_json(spark, [spec(1, "COUNT", "n", windows=("10m", "today")), spec(2, "COUNT", "g", windows=("10m",), groupByField="ext.k")]))
    paths = streaming.StreamPaths(f"{root}/panes", f"{root}/features", f"{root}/checkpoint")
    records = spark.readStream.schema(RECORD_SCHEMA).json(f"{root}/src")
    streaming.start_feature_stream(job, records, paths, trigger={"availableNow": True}).awaitTermination()
    assert len(plans) == 1 and "LeftSemi" in plans[0]
    assert not [line for line in plans[0].split("\n") if "BroadcastHashJoin" in line and "LeftSemi" in line and "pane_end_ms" in line + "ts#"
                and "ts#" in line]
    assert "SortMergeJoin" in plans[0]


def test_look_back_takes_one_shuffle(spark):
    """Both halves of a look-back come from one exchange of the panes."""
    job = FeatureJob(specs_from_json(spark, [spec(1, "SUM", "s", windows=("10m", "3h"), field="ext.k", fieldType="long")]))
    path = scratch_path(spark, "panes")
    spark.createDataFrame([], PANE_SCHEMA).write.parquet(path)
    plan = _plan(rollup_all(spark.read.schema(PANE_SCHEMA).parquet(path), job.compiled, MIN))
    assert plan.count("Exchange hashpartitioning") == 1


def test_distinct_states_are_words(spark):
    """a state is 8 bytes, however far its values are apart."""
    job = FeatureJob(specs_from_json(spark, [spec(1, "DISTINCT", "d", field="ext.k", fieldType="long")]))
    states = [r.state for r in pane_partials(job.routed(make_records(spark, _events())), {"distinct"}).collect()]
    assert states and {len(s) for s in states} == {8}


def test_pieces_are_shuffled_once(spark):
    """what the sessions are read from is written, so nothing but edges and entries is shuffled after it."""
    job = FeatureJob(specs_from_json(spark, [spec(1, "SUM", "s", field="ext.k", fieldType="long")]))
    plan = _plan(build_session_panes(job.routed(make_records(spark, _events())), gap_ms=10 * MIN))
    assert "session-pieces" in plan and "session-slots" in plan
    assert "slot#" not in plan.split("Union")[1].split("session-pieces")[0]


def test_long_code_is_left_to_compiled_operators(spark):
    """jobs that build panes run below the length that HotSpot compiles, and the session's own setting comes back."""
    before = spark.conf.get(METHOD_LIMIT, "65535")
    with compiled_code_only(spark):
        assert int(spark.conf.get(METHOD_LIMIT)) <= 8000
    assert spark.conf.get(METHOD_LIMIT, "65535") == before
