"""Quality classifier: held-out accuracy, exact votes, odd rows."""

import zlib

import numpy as np
from llm_helpers import documents

from tumbleweed.llm import quality
from tumbleweed.llm.queries import QUERIES


def test_held_out_accuracy_and_contract(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in QUERIES["op3_quality"](spark, sf).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(rows[i]["predicted"], y) for i, y in labels.items() if rows[i]["held_out"]]
    assert np.mean([p == y for p, y in held]) >= 0.9
    good = [p for p, y in held if y == 1]
    assert np.mean(good) >= 0.95


def test_votes_equal_brute_force():
    rng = np.random.default_rng(0)
    counts = rng.poisson(0.05, size=(60, quality.TERMS)).astype(np.float32)
    m = quality.Model(quality.term_weights((counts > 0).sum(axis=0).astype(float), 60), None, None, rng.integers(0, 2, 40).astype(float))
    m.basis = quality.latent_basis(m.weigh(counts[:40]), 16).astype(np.float32)
    m.vectors = m.latent(counts[:40])
    for got, z in zip(m.scores(counts[40:]), m.latent(counts[40:]), strict=True):
        near = sorted(((float(z @ v), y) for v, y in zip(m.vectors, m.labels)), reverse=True)[:quality.NEIGHBOURS]
        weight = [max(c, 0) ** quality.POWER for c, _ in near]
        want = sum(w * y for w, (_, y) in zip(weight, near)) / sum(weight) if sum(weight) > 1e-9 else m.labels.mean()
        assert abs(got - want) < 1e-3


def test_odd_rows(spark):
    df = documents(spark, [(1, None), (2, ""), (2, ""), (3, "good words " * 200_000), (4, "é" * 50), (None, "some text")]).selectExpr("*", "1 as score", "2 as predicted")
    labels = spark.createDataFrame([(3, 1), (3, 0), (4, 1), (None, 0), (2, None), (99, 1)], "doc_id long, quality int")
    model = quality.fit(df, labels)
    got = quality.score(df, model).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns
    none = quality.fit(df, labels.limit(0))
    assert {r["score"] for r in quality.score(df, none).collect()} == {0.5} and quality.keep_good(df, none).count() == 6
    assert quality.score(df.limit(0), model).count() == 0 and quality.fit(df.limit(0), labels) is not None
    assert not any(r["held_out"] for r in got if r["doc_id"] is None)


def test_labels_of_held_out_rows_change_nothing(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) as quality")
    a, b = quality.fit(docs, labels), quality.fit(docs, flipped)
    assert np.array_equal(a.labels, b.labels) and np.array_equal(a.vectors, b.vectors)


def test_ties_at_the_last_neighbour_share_its_votes():
    rng = np.random.default_rng(3)
    base = rng.poisson(0.05, size=(4, quality.TERMS)).astype(np.float32)
    sample = base[[0] * 10 + [1] * 20 + [2] * 5]  # 20 equal documents for the 5 votes that are left
    labels = np.array([1] * 10 + [0] * 15 + [1] * 5 + [0] * 5, dtype=float)
    m = quality.Model(quality.term_weights((base > 0).sum(axis=0).astype(float), 4), None, None, labels)
    m.basis = quality.latent_basis(m.weigh(base), 3).astype(np.float32)
    m.vectors = m.latent(sample)
    query = base[:1] * 3 + base[1:2]
    cos = (m.latent(query) @ m.vectors.T)[0]
    w = np.maximum(cos.astype(float), 0) ** quality.POWER
    want = (w[:10].sum() + 5 * w[10] * 0.25) / (w[:10].sum() + 5 * w[10])
    assert abs(m.scores(query)[0] - want) < 1e-5
    back = quality.Model(m.idf, m.basis, m.vectors[::-1], labels[::-1])
    assert back.scores(query)[0] == m.scores(query)[0]
