"""Packing: optimal bounds, whole sequences, budgets."""

import itertools

import numpy as np
import pytest
from llm_helpers import documents

from tumbleweed.llm import packing
from tumbleweed.llm.queries import QUERIES


def test_bounds_equal_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(20):
        lengths = rng.choice(np.arange(1, 60), size=9, replace=False)
        counts = rng.integers(1, 50, size=9)
        for buckets in (1, 2, 4, 9, 12):
            bounds = packing.bucket_bounds(lengths, counts, buckets)
            cost = lambda bs: sum(int(c) * min(b for b in bs if b >= x) for x, c in zip(lengths, counts))
            top = int(lengths.max())
            want = min(cost((*rest, top)) for n in range(min(buckets, 9)) for rest in itertools.combinations(sorted(set(lengths.tolist()) - {top}), n))
            assert bounds == sorted(set(bounds)) and len(bounds) <= buckets and cost(bounds) == want
    assert packing.bucket_bounds(np.array([], np.int64), np.array([], np.int64), 4) == []
    wide = packing.bucket_bounds(np.arange(1, 1001), np.ones(1000, np.int64), 4)
    assert len(wide) == 4 and wide[-1] == 1000


def check(rows, texts, max_len, budget, buckets):
    """Every byte is in one segment; batches are full and within their budget."""
    by_doc, batches = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        if r["bucket"] is None:
            assert r["length"] == 0 and r["batch"] is None and r["slot"] is None and r["padded"] is None
        else:
            batches.setdefault((r["bucket"], r["batch"]), []).append(r)
    for i, text in texts.items():
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["segment"]):
            assert r["start"] == at and 0 <= r["length"] <= max_len
            at += r["length"]
        assert at == len((text or "").encode())
    sizes = {}
    for (bucket, batch), b in batches.items():
        padded = {r["padded"] for r in b}
        assert len(padded) == 1 and all(r["length"] <= r["padded"] for r in b)
        assert len(b) * padded.pop() <= budget and sorted(r["slot"] for r in b) == list(range(len(b)))
        sizes.setdefault(bucket, {})[batch] = len(b)
    assert len(sizes) <= buckets
    for per in sizes.values():
        assert sorted(per) == list(range(len(per)))
        assert all(per[i] == max(per.values()) for i in range(len(per) - 1))  # only the last batch may be short


def test_odd_rows(spark):
    rng = np.random.default_rng(0)
    texts = {i: "é" * int(n) for i, n in enumerate(rng.integers(0, 300, size=200))} | {500: None, 501: "", 502: "z" * 100_000}
    df = documents(spark, list(texts.items())).repartition(5).selectExpr("*", "1 as bucket", "2 as at", "3 as part")
    check(packing.pack(df, max_len=256, buckets=5, budget=1024).collect(), texts, 256, 1024, 5)
    twice = df.union(df.where("doc_id = 502"))
    assert packing.pack(twice, max_len=256, budget=1024).where("doc_id = 502").count() == 2 * 391
    assert packing.pack(df.limit(0)).count() == 0
    assert packing.pack(df.where("doc_id >= 500 and doc_id < 502")).collect()[0]["bucket"] is None
    given = packing.pack(df.selectExpr("doc_id", "cast(10 as long) as n_tokens"), length="n_tokens", max_len=8, budget=16).collect()
    assert {(r["segment"], r["length"]) for r in given} == {(0, 8), (1, 2)}
    with pytest.raises(ValueError):
        packing.pack(df, max_len=10, budget=5)


def test_query_packs_everything(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    check(QUERIES["op7_packing"](spark, sf_dir).collect(), texts, packing.MAX_LEN, packing.BUDGET, packing.BUCKETS)
