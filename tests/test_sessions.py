"""Sessions by interval merge against a walk through the events."""

import random
from collections import defaultdict

import pytest
from feature_helpers import event, make_records, spec

from tumbleweed.operators.sessions import build_session_panes, session_slots
from tumbleweed.plans.job import FeatureJob
from tumbleweed.sources.specs import specs_from_json

GAP = 1_000
SPECS = [spec(1, "COUNT", "n"), spec(2, "SUM", "s", field="ext.k", fieldType="long"), spec(3, "MAX", "hi", field="ext.k", fieldType="long"),
         spec(4, "LIST", "l", field="ext.k", capacity=2), spec(5, "SET", "d", field="ext.k", capacity=2), spec(6, "LATEST", "z", field="ext.k")]


def _routed(spark, events):
    job = FeatureJob(specs_from_json(spark, SPECS))
    return job.routed(make_records(spark, events))


def _walk(events):
    """{(uid, start): (end, ks with times)}"""
    by_uid = defaultdict(list)
    for e in events:
        by_uid[e["uid"]].append((e["ext"]["eventTime"], e["ext"]["k"]))
    out = {}
    for uid, rows in by_uid.items():
        session = []
        for t, k in [*sorted(rows), (None, None)]:
            if session and (t is None or t - session[-1][0] >= GAP):
                out[uid, session[0][0]] = (session[-1][0] + GAP, session)
                session = []
            session.append((t, k))
    return out


def _newest(pairs, n):
    return [{"ts": t, "value": v} for t, v in sorted(pairs, reverse=True)[:n]]


@pytest.mark.parametrize("slots_in_bucket", [1, 3, 1024])
def test_sessions_equal_a_walk(spark, slots_in_bucket):
    rng = random.Random(slots_in_bucket)
    events, t = [], 50_000
    for _ in range(400):  # a busy key: gaps of exactly the gap, just below it, and far beyond; sessions over many buckets
        t += rng.choice([0, 1, 400, GAP - 1, GAP - 1, GAP, GAP + 1, 9 * GAP])
        events.append(event("busy", t, k=rng.randrange(6)))
    events += [event(f"u{i % 7}", rng.randrange(60_000), k=i % 5) for i in range(60)]
    events.append(event("early", -2_500, k=1))  # slots before the epoch
    events.append(event("early", -1_700, k=2))
    got = {(r.id, r.feature, r.session_start_ms): r for r in build_session_panes(_routed(spark, events), GAP, slots_in_bucket).collect()}
    want = _walk(events)
    assert len(got) == len(SPECS) * len(want)
    for (uid, start), (end, rows) in want.items():
        of = {f: got[uid, f, start] for f in ("n", "s", "hi", "l", "d", "z")}
        assert {r.session_end_ms for r in of.values()} == {end}
        assert of["n"].cnt == len(rows) and of["s"].num_long == sum(k for _, k in rows) and of["hi"].num_long == max(k for _, k in rows)
        items = {f: [x.asDict() for x in of[f]["items"]] for f in ("l", "d", "z")}
        assert items["l"] == _newest({(t, str(k)) for t, k in rows}, 2)
        assert items["d"] == _newest({(max(t for t, k in rows if k == v), str(v)) for v in {k for _, k in rows}}, 2)
        assert items["z"] == _newest({(t, str(k)) for t, k in rows}, 1)


def test_a_busy_key_is_few_slots_and_fewer_edges(spark):
    events = [event("busy", t, k=1) for t in range(0, 64 * GAP, 50)]  # one session over 64 slots
    slots = session_slots(_routed(spark, events), GAP).where("feature = 'n'").collect()
    assert len(slots) == 64 and sum(r.cnt for r in slots) == len(events)
    [row] = build_session_panes(_routed(spark, events), GAP, 8).where("feature = 'n'").collect()
    assert (row.session_start_ms, row.session_end_ms, row.cnt) == (0, 64 * GAP - 50 + GAP, len(events))


def test_no_events(spark):
    assert build_session_panes(_routed(spark, [event("a", None, k=1)]), GAP).count() == 0
