"""Roll-up semantics on hand-computed fixtures (F-2, F-3, F-6 and the edge cases of FIXTURES §3)."""

import json

from feature_helpers import as_dict, event, features, spec

MIN, HOUR = 60_000, 3_600_000
T = 1_704_067_200_000 + 10 * HOUR   # a pane end (2024-01-01 10:00 UTC)


def at(pane_end):
    return pane_end - 30_000        # an event time inside the pane ending at pane_end


def test_pane_history_f2(spark):
    """F-2: partial 3 at T, T-5m, T-30m, T-1h, T-2h, T-3h, T-4h."""
    offsets = [0, 5 * MIN, 30 * MIN, HOUR, 2 * HOUR, 3 * HOUR, 4 * HOUR]
    uid = "entity-17"
    evs = [event(uid, at(T - o), latitude=3) for o in offsets]
    evs += [event(uid, at(T - o), latitude=0) for o in offsets for _ in range(2)]
    specs = [
        {**spec(1, "SUM", "lat", windows=("10m", "3h"), field="ext.latitude", fieldType="long"),
         "windows": [{"delay": "1s", "window": "5m"}, {"delay": "1m", "window": "10m"},
                     {"delay": "1m", "window": "3h"}]},
        spec(2, "COUNT", "n", windows=("10m", "3h")),
    ]
    out = as_dict(features(spark, specs, evs), value="value_long")
    assert out[(uid, "lat_10m", T)] == 6
    assert out[(uid, "lat_3h", T)] == 15          # T-3h is outside (T-3h, T]
    assert out[(uid, "n_10m", T)] == 6 and out[(uid, "n_3h", T)] == 15
    # 5m has the 1-second cadence: a value at the end of each active second, none at minute ends
    assert out[(uid, "lat_5m", at(T) + 1_000)] == 3 and out[(uid, "lat_5m", at(T - 5 * MIN) + 1_000)] == 3
    assert sum(k[1] == "lat_5m" for k in out) == len(offsets)


def test_set_newest_first_f3(spark):
    """F-3: members 1..8 at times 1..8; the newest four, newest first."""
    evs = [event("u", at(T) - 9_000 + i * 1_000, v=str(i)) for i in range(1, 9)]
    out = as_dict(features(spark, [spec(1, "SET", "s", field="ext.v", capacity=4)], evs))
    assert json.loads(out[("u", "s_10m", T)]) == ["8", "7", "6", "5"]


def test_list_bounds_f6(spark):
    evs = [event("u", at(T) - i * 1_000, v=str(i)) for i in range(6)]
    specs = [spec(1, "LIST", "big", field="ext.v", capacity=100), spec(2, "LIST", "one", field="ext.v", capacity=1)]
    out = as_dict(features(spark, specs, evs))
    assert len(json.loads(out[("u", "big_10m", T)])) == 6
    assert json.loads(out[("u", "one_10m", T)]) == ["0"]


def test_list_across_panes_and_time_field(spark):
    """LIST reads newest items across panes; a non-clock time field orders by that field."""
    evs = [event("u", at(T - 2 * MIN), v="a", t2=50), event("u", at(T - MIN), v="b", t2=10),
           event("u", at(T), v="c", t2=30)]
    specs = [spec(1, "LIST", "l", field="ext.v", capacity=2),
             spec(2, "LIST", "lt", field="ext.v", capacity=2, eventTimeField="ext.t2", needTs=True)]
    out = as_dict(features(spark, specs, evs))
    assert json.loads(out[("u", "l_10m", T)]) == ["c", "b"]
    assert json.loads(out[("u", "lt_10m", T)]) == ["a|50", "c|30"]


def test_unparsable_numbers_d11(spark):
    evs = [event("u", at(T), x="abc"), event("u", at(T), x="5")]
    specs = [spec(1, "SUM", "s", field="ext.x", fieldType="long"),
             spec(2, "MAX", "mx", field="ext.x", fieldType="long"),
             spec(3, "MIN", "mn", field="ext.x", fieldType="long")]
    out = as_dict(features(spark, specs, evs), value="value_long")
    assert out[("u", "s_10m", T)] == 5 and out[("u", "mx_10m", T)] == 5 and out[("u", "mn_10m", T)] == 0


def test_double_kinds(spark):
    evs = [event("u", at(T), x=1.25), event("u", at(T - MIN), x=2.5)]
    specs = [spec(1, "SUM", "s", field="ext.x", fieldType="double"),
             spec(2, "MAX", "mx", field="ext.x", fieldType="double")]
    out = as_dict(features(spark, specs, evs), value="value_double")
    assert out[("u", "s_10m", T)] == 3.75 and out[("u", "mx_10m", T)] == 2.5


def test_pipe_in_value_and_ties_d15(spark):
    evs = [event("u", at(T), v="a|b"), event("u", at(T), v="z")]
    out = as_dict(features(spark, [spec(1, "LIST", "l", field="ext.v", capacity=5, needTs=True)], evs))
    t = at(T)
    assert json.loads(out[("u", "l_10m", T)]) == [f"z|{t}", f"a|b|{t}"]   # equal times: greater value first


def test_set_exact_distinct_d5(spark):
    evs = [event("u", at(T) - i * 1_000, v="x") for i in range(5)] + [event("u", at(T) - 20_000, v="y")]
    out = as_dict(features(spark, [spec(1, "SET", "s", field="ext.v", capacity=2)], evs))
    assert json.loads(out[("u", "s_10m", T)]) == ["x", "y"]


def test_grouped_carry_over_and_null_group(spark):
    evs = [event("u", at(T - 5 * MIN), g="g1"), event("u", at(T), g="g2"), event("u", at(T))]
    out = as_dict(features(spark, [spec(1, "COUNT", "c", groupByField="ext.g")], evs), value="value_long")
    assert out[("u", "c_g1_10m", T)] == 1 and out[("u", "c_g2_10m", T)] == 1
    assert not any(k[1].startswith("c__") for k in out)   # the event without a group is skipped


def test_same_length_names_d8_and_duplicate_cadence_d13(spark):
    s = spec(1, "COUNT", "c", windows=("60m", "1h"))
    s["windows"].append({"delay": "1min", "window": "10m"})
    out = as_dict(features(spark, [s], [event("u", at(T))]), value="value_long")
    assert out[("u", "c_60m", T)] == 1 and out[("u", "c_1h", T)] == 1 and out[("u", "c_10m", T)] == 1


def test_latest_value_d4(spark):
    evs = [event("u", at(T) - 2_000, v="old"), event("u", at(T), v="b"), event("u", at(T), v="a")]
    out = as_dict(features(spark, [spec(1, "LATEST", "last", field="ext.v")], evs))
    assert out[("u", "last", T)] == "b"


def test_whole_day_windows(spark):
    day = 86_400_000
    d1 = 1_704_067_200_000             # 2024-01-01 00:00 UTC
    evs = [event("u", d1 + HOUR), event("u", d1 + 2 * HOUR), event("u", d1 + day + HOUR)]
    out = as_dict(features(spark, [spec(1, "COUNT", "c", windows=("today", "yesterday"))], evs),
                  value="value_long")
    p = lambda ms: (ms // MIN + 1) * MIN
    assert out[("u", "c_today", p(d1 + 2 * HOUR))] == 2
    assert out[("u", "c_today", p(d1 + day + HOUR))] == 1
    assert out[("u", "c_yesterday", p(d1 + day + HOUR))] == 2
    assert ("u", "c_yesterday", p(d1 + HOUR)) not in out


def test_atoms_skip_blank(spark):
    specs = [{**spec(1, "ATOM", "a", fields=[{"sourceField": "ext.v", "featureName": "v"},
                                             {"sourceField": "ext.missing", "featureName": "m"}]),
              "windows": []}]
    out = as_dict(features(spark, specs, [event("u", 5, v="x"), event("u", 6, v=" ")]))
    assert out == {("u", "a_v", 5): "x"}


LONG = 2**63 - 1


def test_history_outside_a_window_never_hurts_a_sum(spark):
    """A running total may leave BIGINT; each window has a sum of its own."""
    evs = [event("u", at(T), k=str(LONG)), event("u", at(T + HOUR), k="5"), event("u", at(T + 2 * HOUR), k="7")]
    out = as_dict(features(spark, [spec(1, "SUM", "s", windows=("10m",), field="ext.k", fieldType="long")], evs), value="value_long")
    assert out == {("u", "s_10m", T): LONG, ("u", "s_10m", T + HOUR): 5, ("u", "s_10m", T + 2 * HOUR): 7}


def test_a_sum_beyond_bigint_is_null(spark):
    """In one pane, and over the panes of a window; later windows recover."""
    evs = [event("u", at(T), k=str(LONG)), event("u", at(T) + 1_000, k="1"), event("u", at(T + MIN), k="5"), event("u", at(T + 20 * MIN), k="6"),
           event("v", at(T), k=str(LONG)), event("v", at(T + MIN), k="5")]
    out = as_dict(features(spark, [spec(1, "SUM", "s", windows=("10m",), field="ext.k", fieldType="long")], evs), value="value_long")
    assert out == {("u", "s_10m", T): None, ("u", "s_10m", T + MIN): None, ("u", "s_10m", T + 20 * MIN): 6,
                   ("v", "s_10m", T): LONG, ("v", "s_10m", T + MIN): None}


def test_set_keeps_the_greatest_custom_time(spark):
    """A later pane with an older item time does not hide the newer time."""
    evs = [event("u", at(T), v="x", t2=900), event("u", at(T + MIN), v="x", t2=50), event("u", at(T + MIN), v="y", t2=100),
           event("u", at(T + 12 * MIN), v="y", t2=7)]
    out = as_dict(features(spark, [spec(1, "SET", "s", field="ext.v", capacity=2, eventTimeField="ext.t2", needTs=True)], evs))
    assert json.loads(out[("u", "s_10m", T + MIN)]) == ["x|900", "y|100"]
    assert json.loads(out[("u", "s_10m", T + 12 * MIN)]) == ["y|7"]


def test_all_cadences_in_one_job(spark):
    specs = [spec(1, "COUNT", "m", windows=("10m",)), spec(2, "COUNT", "h", windows=("3h",), delay="1h"),
             {**spec(3, "ATOM", "a", fields=[{"sourceField": "ext.g", "featureName": "g"}]), "windows": []}]
    out = as_dict(features(spark, specs, [event("u", at(T), g="p"), event("u", at(T) + 40_000, g="q")]))
    assert out == {("u", "m_10m", T): "1", ("u", "m_10m", T + MIN): "2", ("u", "h_3h", T): "1", ("u", "h_3h", T + HOUR): "2",
                   ("u", "a_g", at(T)): "p", ("u", "a_g", at(T) + 40_000): "q"}


def test_one_busy_key_equals_brute_force(spark):
    """Thousands of one-second panes of a single key, over look-backs of several block lengths."""
    import random

    rng = random.Random(4)
    times = sorted(rng.sample(range(1, 40_000), 3000))
    evs = [event("u", 1_000 * t, x=rng.randrange(-50, 50)) for t in times]
    values = {t + 1: e["ext"]["x"] for t, e in zip(times, evs)}      # by pane end in seconds
    kinds = {"SUM": sum, "MAX": max, "MIN": min}
    specs = [spec(i, k, k.lower(), windows=("7s", "5m", "3h"), delay="1s", field="ext.x", fieldType="double") for i, k in enumerate(kinds)]
    specs.append(spec(9, "COUNT", "count", windows=("7s", "5m", "3h"), delay="1s"))
    out = as_dict(features(spark, specs, evs, pane_ms=1_000), key=("feature_name", "ts"))
    ends = sorted(values)
    for name, w in (("7s", 7), ("5m", 300), ("3h", 10_800)):
        lo = 0
        for i, end in enumerate(ends):
            while ends[lo] <= end - w:
                lo += 1
            seen = [values[t] for t in ends[lo:i + 1]]
            assert out[(f"count_{name}", end * 1_000)] == str(len(seen))
            for k, f in kinds.items():
                assert float(out[(f"{k.lower()}_{name}", end * 1_000)]) == f(seen)


def _random_items(n=400, seed=3):
    import random

    rng = random.Random(seed)
    return [event(rng.choice("ab"), rng.randrange(0, 9_000_000), v=rng.choice("pqrst"), at=rng.randrange(0, 50)) for _ in range(n)]


ITEM_SPECS = [spec(1, "LIST", "l", windows=("10m", "1h"), field="ext.v", capacity=4, needTs=True),
              spec(2, "SET", "s", windows=("10m", "1h"), field="ext.v", capacity=3, needTs=True),
              spec(3, "LIST", "lc", windows=("10m",), field="ext.v", capacity=4, needTs=True, eventTimeField="ext.at"),
              spec(4, "SET", "sc", windows=("10m", "1h"), field="ext.v", capacity=3, needTs=True, eventTimeField="ext.at")]


def test_items_in_cells_equal_items_in_one_array(spark, monkeypatch):
    """Look-backs of many panes are merged in two levels; the result is that of one."""
    from tumbleweed.operators import rollup

    events = _random_items()
    want = as_dict(features(spark, ITEM_SPECS, events))
    monkeypatch.setattr(rollup, "ARRAY_PANES", 0)
    assert as_dict(features(spark, ITEM_SPECS, events)) == want and len(want) > 800


def test_no_task_holds_a_whole_history(spark):
    """Every shuffle of panes is dealt by block or day as well as by key: a busy key is spread over them."""
    import re

    specs = [spec(1, "COUNT", "c", windows=("10m", "today", "yesterday")), spec(2, "COUNT", "g", windows=("10m", "today", "yesterday"), groupByField="ext.v"),
             spec(3, "SUM", "s", windows=("1h", "today"), field="ext.at", fieldType="long"), *[{**s, "id": 10 + s["id"]} for s in ITEM_SPECS]]
    df = features(spark, specs, _random_items(40))
    plan = df._jdf.queryExecution().executedPlan().toString()
    dealt = set(re.findall(r"hashpartitioning\(([^)]*)\)", plan))
    by_key = [d for d in dealt if "feature#" in d]
    assert by_key and all(re.search(r"\b(b|day|pane_end_ms|t|cell|_groupingexpression)#", d) for d in by_key), by_key
    assert "Nested" not in plan and "Cartesian" not in plan
