from pyspark.sql import functions as F

from tumbleweed.operators.sinks import cell_snapshot, feature_messages, serving_cells
from tumbleweed.plans.catalog import EVENT_SPECS, EXPECTED_ERRORS
from tumbleweed.plans.compile import compile_specs
from tumbleweed.plans.job import FeatureJob
from tumbleweed.sources.specs import specs_from_json

from feature_helpers import event, make_records, spec


def test_validation_isolates_bad_specs(spark):
    cs = compile_specs(specs_from_json(spark, EVENT_SPECS))
    errors = {r.spec_id: r.error for r in cs.validation.collect()}
    assert errors == EXPECTED_ERRORS
    assert {r.spec_id for r in cs.rows["specs"]} == {s["id"] for s in EVENT_SPECS} - set(EXPECTED_ERRORS)


def test_other_rules(spark):
    bad = [spec(1, "SUM", "a", field="ext.x"),                        # no fieldType
           spec(2, "COUNT", "b", windows=()),                          # no windows
           {**spec(3, "COUNT", "c"), "windows": [{"delay": "2x", "window": "10m"}]},
           spec(4, "LIST", "d", field="ext.x", capacity=0),
           {**spec(5, "COUNT", "e"), "typeConfig": []}]
    errors = {r.spec_id: r.error for r in compile_specs(specs_from_json(spark, bad)).validation.collect()}
    assert errors == {1: "bad fieldType: null", 2: "no windows", 3: "bad delay: 2x",
                      4: "capacity must be >= 1", 5: "empty typeConfig"}


def test_an_invalid_namesake_takes_nothing_down(spark):
    specs = [{**spec(1, "MEDIAN", "c")}, spec(2, "COUNT", "c"), spec(3, "COUNT", "c"), spec(2, "COUNT", "other"), spec(4, "COUNT", "c", id_type="targetUid")]
    job = FeatureJob(specs_from_json(spark, specs), materialize=False)
    assert {(r.spec_id, r.error) for r in job.compiled.validation.collect()} == {
        (1, "unknown kind: median"), (2, "duplicate id"), (3, "duplicate featureNamePrefix for idType")}
    rows = job.features(make_records(spark, [event("u", 30_000)])).collect()
    assert [(r.feature_name, r.value_long) for r in rows] == [("c_10m", 1)]


def test_sink_types_without_writer_are_reported(spark):
    s = spec(1, "COUNT", "c")
    s["sinks"] = [{"type": "kafka", "fields": {}}, {"type": "hbase", "fields": {"c_10m": {"table": "t", "ttl": 0, "rename": "n"}}}, {"type": None, "fields": {}}]
    job = FeatureJob(specs_from_json(spark, [s]), materialize=False)
    assert {(r.spec_id, r.error) for r in job.compiled.validation.collect()} == {(1, "no writer for sink type: kafka"), (1, "no writer for sink type: null")}
    cells = serving_cells(job.features(make_records(spark, [event("u", 30_000)])), job.compiled)
    assert [r.column for r in cells.collect()] == ["n"]


def test_sinks(spark):
    s = spec(1, "COUNT", "c", windows=("10m", "3h"))
    s["sinks"] = [{"type": "HBase", "fields": {"c_10m": {"table": "t", "ttl": 60, "rename": "cnt"},
                                               "c_3h": {"table": "t", "ttl": 0, "rename": " "}}}]
    job = FeatureJob(specs_from_json(spark, [s]), materialize=False)
    feats = job.features(make_records(spark, [event("id42", 30_000), event("id42", 90_000)]))
    cells = serving_cells(feats, job.compiled)
    rows = sorted((r.table, r.row_key, r.column, r.ts, r.value, r.ttl_ms) for r in cells.collect())
    assert rows == [("t", "2id42", "c_3h", 60_000, "1", None), ("t", "2id42", "c_3h", 120_000, "2", None),
                    ("t", "2id42", "cnt", 60_000, "1", 60_000), ("t", "2id42", "cnt", 120_000, "2", 60_000)]
    snap = {r.column: (r.ts, r.value, r.expires_at_ms) for r in cell_snapshot(cells).collect()}
    assert snap == {"cnt": (120_000, "2", 180_000), "c_3h": (120_000, "2", None)}
    assert cell_snapshot(cells, as_of_ms=200_000).where(F.col("column") == "cnt").count() == 0
    msgs = feature_messages(cells).collect()
    assert len(msgs) == 2 and all(m.biz_type == "game" for m in msgs)
    assert msgs[0].value.startswith('{"id":"id42","dataType":"uid"')


def test_restrict_features_prunes_windows_atoms_and_routes(spark):
    specs = [spec(1, "COUNT", "c", windows=("10m", "3h")),
             spec(2, "COUNT", "g", windows=("10m",), groupByField="ext.g"),
             spec(3, "SUM", "s", windows=("10m",), field="ext.x", fieldType="long"),
             {**spec(4, "ATOM", "a", fields=[{"sourceField": "ext.g", "featureName": "g"},
                                             {"sourceField": "ext.x", "featureName": "x"}]), "windows": []}]
    job = FeatureJob(specs_from_json(spark, specs), materialize=False)
    job.compiled = job.compiled.restrict_features(["c_3h", "g_p_10m", "a_x"])
    assert {(w.spec_id, w.window) for w in job.compiled.rows["windows"]} == {(1, "3h"), (2, "10m")}
    assert {r.spec_id for r in job.compiled.rows["routes"]} == {1, 2, 4}      # spec 3 is never routed
    evs = [event("u", 30_000, g="p", x=5)]
    names = {r.feature_name for r in job.features(make_records(spark, evs)).collect()}
    assert names == {"c_3h", "g_p_10m", "a_x"}


def test_batches_fire_by_count_or_time(spark):
    from tumbleweed.operators.sinks import message_batches

    rows = [("u", "uid", "b", 1_000 + i, f"c{i % 3}", str(i)) for i in range(5)] + [("u", "uid", None, 1_001, "x", "-"), ("u", "uid", "b", 2_500, "c0", "late"),
                                                                                   ("w", "uid", "b", 1_000, "c0", "w"), ("w", "uid", "d", 1_000, "c1", "d")]
    cells = spark.createDataFrame(rows, "id string, id_type string, biz_type string, ts long, column string, value string")
    got = sorted((r.id, r.biz_type, r.ts, r.batch, tuple(sorted(r.kv.items()))) for r in message_batches(cells, max_rows=4).collect())
    assert got == [("u", "b", 1_002, 0, (("c0", "0"), ("c1", "1"), ("c2", "2"))), ("u", "b", 1_004, 1, (("c0", "3"), ("c1", "4"))),
                   ("u", "b", 2_500, 0, (("c0", "late"),)), ("w", "b", 1_000, 0, (("c0", "w"),)), ("w", "d", 1_000, 0, (("c1", "d"),))]
    assert message_batches(cells.limit(0)).count() == 0
