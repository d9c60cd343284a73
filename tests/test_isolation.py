"""One bad spec, value, clock or id never touches the others."""

from feature_helpers import as_dict, event, features, make_records, spec

from tumbleweed.plans.compile import compile_specs
from tumbleweed.plans.job import FeatureJob
from tumbleweed.sources.events import parse_events
from tumbleweed.sources.specs import specs_from_json

T = 60_000


def atom(id, prefix, *texts):
    return {**spec(id, "ATOM", prefix, fields=[{"sourceField": t, "featureName": str(i)} for i, t in enumerate(texts)]), "windows": []}


def test_bad_expressions_are_reported_and_the_rest_runs(spark):
    specs = [spec(1, "COUNT", "c"), spec(2, "SUM", "s", field="ext.k +", fieldType="long"), spec(3, "MAX", "m", field="nope(ext.k)", fieldType="long"),
             atom(4, "a", "ext.k", "sum(ext.k)"), spec(5, "COUNT", "g", groupByField="explode(split(uid, '')) ")]
    job = FeatureJob(specs_from_json(spark, specs), materialize=False)
    assert {r.spec_id: r.error for r in job.compiled.validation.collect()} == {
        2: "bad expression: ext.k +", 3: "bad expression: nope(ext.k)", 4: "bad expression: sum(ext.k)",
        5: "bad expression: explode(split(uid, '')) "}
    assert [r.value_long for r in job.features(make_records(spark, [event("u", 1_000, k="3")])).collect()] == [1]


def test_event_fields_and_nested_paths(spark):
    evs = [{**event("u", 1_000, k="3", o={"a": {"b": 7}}), "pay": {"amount": 12}, "roomId": "r9"}]
    texts = ["upper(bizType)", "pay.amount", "ext.o.a.b", "concat(roomId, '-', eventType, '-bizType')", "ext.k * 2", "(ext.k + 1) / 2", "ext.k || '+x'", "1 - ext.k"]
    out = as_dict(features(spark, [atom(1, "a", *texts)], evs), key=("feature_name",))
    assert out == {("a_0",): "GAME", ("a_1",): "12", ("a_2",): "7", ("a_3",): "r9-pay-bizType", ("a_4",): "6", ("a_5",): "2",
                   ("a_6",): "3+x", ("a_7",): "-2"}


def test_bad_values_give_no_value_for_their_row_only(spark):
    evs = [event("u", 1_000 + i, k=k) for i, k in enumerate(["abc", "4", "1.5", "", "9" * 30, None, str(2**63 - 1)])]
    out = as_dict(features(spark, [atom(1, "a", "ext.k * 2", "ext.k / 0", "ext.k * ext.k * ext.k"), spec(2, "COUNT", "c")], evs), key=("feature_name", "ts"))
    assert {t: v for (n, t), v in out.items() if n == "a_0"} == {1_001: "8", 1_002: "3.0", 1_004: "2.0E30", 1_006: str(2 * (2**63 - 1))}
    assert not any(n == "a_1" for n, _ in out)
    assert {t: v for (n, t), v in out.items() if n == "a_2"}[1_001] == "64"
    assert out[("c_10m", T)] == "7"


def test_bad_clocks_become_rejects(spark):
    evs = [event("u", 1_000), event("u", 2**63 - 1), event("u", -(2**63)), event("u", "soon")]
    good, rejects = parse_events(make_records(spark, evs), with_rejects=True)
    assert good.count() == 2 and sorted(r.reason for r in rejects.collect()) == ["clock out of range"] * 2
    assert as_dict(features(spark, [spec(1, "COUNT", "c")], evs)) == {("u", "c_10m", T): "1"}


def test_ids_of_white_space_are_blank(spark):
    evs = [event(i, 1_000) for i in ("\t", "\n \r", "", " ", "a b")]
    assert set(as_dict(features(spark, [spec(1, "COUNT", "c")], evs))) == {("a b", "c_10m", T)}


def test_no_matching_event(spark):
    specs = specs_from_json(spark, [spec(1, "COUNT", "c"), spec(2, "SET", "s", field="ext.k", capacity=2)])
    job = FeatureJob(specs)
    assert job.features(make_records(spark, [event("u", 1_000, biz="other")])).count() == 0
    assert job.features(make_records(spark, [event("u", 1_000)]).limit(0)).count() == 0


def test_incremental_runs_keep_earlier_dates(spark, tmp_path):
    day = 86_400_000
    job = FeatureJob(specs_from_json(spark, [spec(1, "COUNT", "c", windows=("7d",))]), pane_path=f"{tmp_path}/panes")
    job.features(make_records(spark, [event("u", 1_000), event("u", 2_000)])).collect()
    job.features(make_records(spark, [event("u", day + 1_000)])).collect()
    again = job.features(make_records(spark, [event("u", day + 1_000), event("u", day + 2_000)]))
    assert as_dict(again, value="value_long") == {("u", "c_7d", T): 2, ("u", "c_7d", day + T): 4}


def test_a_large_spec_set_compiles(spark):
    import time

    specs = specs_from_json(spark, [spec(i, "COUNT", f"c{i}", windows=("10m", "3h")) for i in range(5000)])
    specs.count()
    t0 = time.time()
    cs = compile_specs(specs)
    assert len(cs.rows["windows"]) == 10_000 and cs.windows.count() == 10_000
    assert time.time() - t0 < 60
