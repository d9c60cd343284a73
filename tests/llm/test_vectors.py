"""Vector searches against brute force."""

import numpy as np
import pytest

from tumbleweed.llm import ann, topk
from tumbleweed.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, block string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)


def brute(rows, every, k, score):
    out = {}
    for q, v in rows:
        if q % every == 0:
            hits = sorted(((-score(v, w), i) for i, w in rows if i != q))[:k]
            out[q] = [(i, -s) for s, i in hits]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def odd_rows(nonzero):
    """A third of equal vectors, ties, and rows that take no part."""
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=8).round(1).tolist()) for i in range(60)] + [(i, [0.5] * 8) for i in range(60, 95)]
    bad = [(200, None), (210, [None] * 8), (220, [float("nan")] * 8), (230, [float("inf")] + [0.0] * 7), (240, []), (250, [1.0]), (None, [1.0] * 8)]
    zero = [(300, [0.0] * 8)]
    return (good + ([] if nonzero else zero)), bad + (zero if nonzero else [])


def test_exact_top_k_with_ties_and_odd_rows(spark):
    good, bad = odd_rows(nonzero=False)
    df = table(spark, good + bad + good[:7])  # repeated rows count once
    q = lambda v: [int(np.floor(1024 * x)) for x in v]
    want = brute(good, 10, 5, lambda a, b: sum(x * y for x, y in zip(q(a), q(b))))
    assert result(topk.top_k(df, 5, 10, block_rows=16, chunk_rows=4)) == want


def test_exact_top_k_with_few_candidates_and_none(spark):
    two = [(0, [1.0, 2.0]), (7, [3.0, -1.0])]
    assert result(topk.top_k(table(spark, two), 10, 10)) == {0: [(7, 3072 * 1024 - 1024 * 2048)]}
    assert topk.top_k(table(spark, []), 10, 10).count() == 0
    assert topk.top_k(table(spark, [(3, [1.0])]), 10, 10).count() == 0


def test_scores_stay_exact_beyond_doubles():
    a = np.array([[2**40 + 1, 3]], dtype=np.int64)
    assert topk.scores_of(a, np.array([[2**20 + 1, 1]], dtype=np.int64))[0, 0] == (2**40 + 1) * (2**20 + 1) + 3
    assert topk.scores_of(a * 2**20, a * 2**20)[0, 0] == 2**63 - 1 and topk.scores_of(a * 2**20, a * -2**20)[0, 0] == -2**63


def test_large_components_with_small_scores(spark):
    """Finite vectors take part whatever their size, as long as a score itself has 64 bits."""
    wide = lambda *at: [dict(at).get(i, 0.0) for i in range(64)]
    rows = [(0, wide((0, 4e6))), (1, wide((1, 4e6))), (2, wide((0, 2.0), (1, -4e6))), (3, wide((0, -3e5), (5, 1.0))), (100, wide((0, 5e5), (1, -5e5)))]
    got = sorted(tuple(r) for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 3, 100)
                 .select("query_id", "rank", "vec_id", "score").collect())
    z = {i: [int(1024 * x) for x in v] for i, v in rows}
    want = []
    for q in (0, 100):
        best = sorted((-sum(a * b for a, b in zip(z[q], z[i])), i) for i in z if i != q)[:3]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert got == want
    rng = np.random.default_rng(6)
    a, b = (rng.integers(-2**33, 2**33, size=(6, 5)) for _ in range(2))
    b[:, 4] = 0
    exact = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
    fits = all(-2**63 <= x < 2**63 for r in exact for x in r)
    if fits:
        assert topk.scores_of(a, b).tolist() == exact
    c = np.array([[2**62, 2**62, -2**62]], dtype=np.int64)
    assert topk.scores_of(c, np.array([[1, 1, 1], [2, -1, 1]])).tolist() == [[2**62, 0]]


def test_ann_is_exact_where_everything_is_in_the_radius(spark):
    good, bad = odd_rows(nonzero=True)
    got = result(ann.search(table(spark, good + bad + good[:7]), 5, 10, bits=32, target=1.0, block_rows=1024))
    want = brute(good, 10, 5, lambda a, b: float(np.dot(a, b)))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert ann.search(table(spark, []), 5, 10).count() == 0


def test_pigeonhole_retrieves_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 16, size=(3000, 4), dtype=np.uint16)
    index = ann.Directory(codes)
    for radius in (0, 3, 17, 26, 64):
        assert sum(t + 1 for t in ann.thresholds(radius, 4)) == radius + 1
        want = np.flatnonzero(ann.distances(codes[5], codes) <= radius)
        assert index.within(codes[5], radius).tolist() == want.tolist()


def test_ann_query_recall(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = brute(rows, 20, 20, lambda a, b: float(np.dot(np.array(a, float), np.array(b, float))))
    got = result(QUERIES["op1_ann_search"](spark, sf_dir))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
