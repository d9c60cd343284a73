from pyspark.sql import functions as F

from tumbleweed.functions.fields import field_value
from tumbleweed.operators.fanout import fan_out
from tumbleweed.sources.events import parse_events

from feature_helpers import event, features, make_records, spec


def test_nested_path_f1(spark):
    """F-1: ``ext.pay`` reads 33 from ``{"uid":"123","ext":{"pay":33}}``."""
    ev = parse_events(make_records(spark, ['{"uid":"123","ext":{"pay":33}}']))
    r = ev.select(field_value(F.lit("ext.pay")).alias("v"), field_value(F.lit("uid")).alias("u")).first()
    assert r.v == "33" and r.u == "123"


def test_malformed_and_rejects(spark):
    recs = make_records(spark, ["not json", '{"uid": 1, "ext": {"eventTime": 5}}', "[1,2]"])
    events, rejects = parse_events(recs, with_rejects=True)
    assert events.count() == 1
    assert sorted(r.reason for r in rejects.collect()) == ["malformed json", "malformed json"]


def test_fanout_independent_f5(spark):
    """F-5: each event is emitted once per id type; branches do not share fields."""
    evs = [{"uid": str(i), "ext": {"targetUid": f"t{i}", "anchorUid": f"a{i}", "eventTime": i}} for i in range(6)]
    fanned = fan_out(parse_events(make_records(spark, evs, topic="LIVEROOM")))
    rows = fanned.select("id_type", "id").collect()
    assert len(rows) == 18
    assert {r.id for r in rows if r.id_type == "targetUid"} == {f"t{i}" for i in range(6)}
    fanned2 = fan_out(parse_events(make_records(spark, evs, topic="USER")))
    assert fanned2.count() == 12   # no anchor dimension on this topic


def test_blank_id_and_missing_ext(spark):
    evs = [{"uid": "  ", "ext": {"targetUid": "x", "eventTime": 1}}, {"uid": "7"}]
    rows = fan_out(parse_events(make_records(spark, evs, topic="USER"))).select("id_type", "id").collect()
    assert sorted((r.id_type, r.id) for r in rows) == [("targetUid", "x"), ("uid", "7")]


def test_id_prefix_stripped_on_windowed_path(spark):
    """``a:1`` and ``b:1`` share the windowed history of entity ``1``."""
    evs = [event("a:1", 1_000), event("b:1", 2_000)]
    out = features(spark, [spec(1, "COUNT", "c", windows=("10m",))], evs)
    rows = out.where("feature_name = 'c_10m'").select("id", "value_long").collect()
    assert [(r.id, r.value_long) for r in rows] == [("1", 2)]


def test_route_absent_parts_are_empty(spark):
    """A route with no targetType matches events without one, and only those."""
    routes = [{"bizType": "game", "eventType": "pay"}]
    evs = [{"uid": "1", "bizType": "game", "eventType": "pay", "ext": {"eventTime": 1}},
           event("2", 1)]
    out = features(spark, [spec(1, "COUNT", "c", routes=routes)], evs)
    assert {r.id for r in out.collect()} == {"1"}
