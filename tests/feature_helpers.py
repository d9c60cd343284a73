"""Small records, specs and feature runs for the tests."""

import json


def make_records(spark, events, topic="LIVEROOM"):
    """Raw ``(topic, key, value)`` records from event dicts (or raw strings)."""
    rows = [(topic, None, e if isinstance(e, str) else json.dumps(e)) for e in events]
    return spark.createDataFrame(rows, "topic string, key string, value string")


def event(uid, ms, event_type="pay", biz="game", target="user", **ext):
    return {"uid": uid, "bizType": biz, "eventType": event_type, "targetType": target,
            "ext": {"eventTime": ms, **ext}}


def spec(id, kind, prefix, windows=("10m",), delay="1m", id_type="uid", routes=None, **agg):
    routes = routes or [{"bizType": "game", "eventType": "pay", "targetType": "user"}]
    wins = []
    for w in windows:
        whole = w in ("today", "yesterday", "lastweek")
        wins.append({"delay": delay, "window": w, "windowType": "wholeWindow" if whole else "relativeWindow"})
    return {"id": id, "configType": kind, "bizType": "game", "idType": id_type, "featureNamePrefix": prefix,
            "typeConfig": routes, "aggConfig": agg, "windows": wins, "sinks": []}


def features(spark, specs, events, pane_ms=60_000, topic="LIVEROOM"):
    from tumbleweed.plans.job import FeatureJob
    from tumbleweed.sources.specs import specs_from_json

    job = FeatureJob(specs_from_json(spark, specs), pane_ms=pane_ms, materialize=False)
    return job.features(make_records(spark, events, topic))


def as_dict(df, key=("id", "feature_name", "ts"), value="value_text"):
    return {tuple(r[k] for k in key): r[value] for r in df.collect()}
