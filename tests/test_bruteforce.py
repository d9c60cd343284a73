"""Dense random events against a naive interpreter of the feature semantics."""

import json
import random

from feature_helpers import event, features, spec

MIN = 60_000
BASE = 1_704_067_200_000


def _naive(events, kind, window_ms, capacity=None, group=False):
    """Features at every active pane end, computed by brute force."""
    out = {}
    by_user = {}
    for e in events:
        by_user.setdefault(e["uid"], []).append(e)
    for uid, evs in by_user.items():
        ends = sorted({(e["ext"]["eventTime"] // MIN + 1) * MIN for e in evs})
        for end in ends:
            inside = [e for e in evs if end - window_ms < (e["ext"]["eventTime"] // MIN + 1) * MIN <= end]
            if kind == "count" and group:
                counts = {}
                for e in inside:
                    counts[e["ext"]["g"]] = counts.get(e["ext"]["g"], 0) + 1
                for g, c in counts.items():
                    out[(uid, f"_{g}", end)] = c
            elif kind == "sum":
                out[(uid, "", end)] = sum(e["ext"]["x"] for e in inside)
            elif kind == "max":
                out[(uid, "", end)] = max(e["ext"]["x"] for e in inside)
            elif kind == "list":
                pairs = sorted({(e["ext"]["eventTime"], e["ext"]["v"]) for e in inside}, reverse=True)
                out[(uid, "", end)] = [v for _, v in pairs[:capacity]]
            elif kind == "list_t2":
                pairs = sorted({(e["ext"]["t2"], e["ext"]["v"]) for e in inside}, reverse=True)
                out[(uid, "", end)] = [f"{v}|{t}" for t, v in pairs[:capacity]]
            elif kind == "set":
                newest = {}
                for e in inside:
                    t, v = e["ext"]["eventTime"], e["ext"]["v"]
                    newest[v] = max(newest.get(v, t), t)
                ranked = sorted(((t, v) for v, t in newest.items()), reverse=True)
                out[(uid, "", end)] = [v for _, v in ranked[:capacity]]
    return out


def _events(seed, n=400, users=3, span_min=90):
    rnd = random.Random(seed)
    evs = []
    for _ in range(n):
        t = BASE + rnd.randrange(span_min * MIN)
        evs.append(event(f"u{rnd.randrange(users)}", t, v=rnd.choice("abcdef"), g=rnd.choice("pqr"),
                         x=rnd.randrange(100), t2=rnd.randrange(10**9)))
    return evs


def test_random_against_naive(spark):
    evs = _events(7)
    specs = [
        spec(1, "SET", "st", windows=("10m", "30m"), field="ext.v", capacity=3),
        spec(2, "LIST", "ls", windows=("10m",), field="ext.v", capacity=4),
        spec(3, "COUNT", "gc", windows=("10m", "30m"), groupByField="ext.g"),
        spec(4, "SUM", "sm", windows=("30m",), field="ext.x", fieldType="long"),
        spec(5, "MAX", "mx", windows=("10m",), field="ext.x", fieldType="long"),
        spec(6, "LIST", "lt", windows=("10m",), field="ext.v", capacity=3, eventTimeField="ext.t2", needTs=True),
    ]
    got = {(r.id, r.feature_name, r.ts): (r.value_long, r.value_text) for r in features(spark, specs, evs).collect()}
    checks = [("st", "set", 10 * MIN, 3, False, "10m"), ("st", "set", 30 * MIN, 3, False, "30m"),
              ("ls", "list", 10 * MIN, 4, False, "10m"), ("gc", "count", 10 * MIN, None, True, "10m"),
              ("gc", "count", 30 * MIN, None, True, "30m"), ("sm", "sum", 30 * MIN, None, False, "30m"),
              ("mx", "max", 10 * MIN, None, False, "10m"), ("lt", "list_t2", 10 * MIN, 3, False, "10m")]
    for prefix, kind, w, cap, grp, wname in checks:
        want = _naive(evs, kind, w, cap, grp)
        mine = {}
        for (uid, name, ts), (vl, vt) in got.items():
            if name.startswith(prefix + "_") and name.endswith("_" + wname):
                middle = name[len(prefix):-len(wname) - 1]
                mine[(uid, middle, ts)] = json.loads(vt) if kind in ("list", "set", "list_t2") else vl
        assert mine == want, (prefix, wname)
