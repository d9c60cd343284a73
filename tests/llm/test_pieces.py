"""SentencePiece sampling: exact round trips, exact probabilities, reproducibility."""

import math
import os
from collections import Counter

import numpy as np
import pytest
from llm_helpers import documents

from tumbleweed.llm import pieces

pytestmark = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="vocabulary file not present")
TEXTS = ["", " ", "Hello  world", "\ttabs\nand lines ", "▁literal ▁ mark▁", "<s> </s> <unk> <0x41>", "日本語と\U0001F600 emoji\u0000nul", "    deep   spaces    ",
         "é\u0301 ñ ü", "a" * 5000, "no-break\u00a0space", "x" * 300 + " " + "word " * 20_000]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary()


def test_round_trip_and_same_ids_for_same_key(spark):
    rows = list(enumerate(TEXTS)) + [(100, None), (2, TEXTS[2]), (None, "no key")]
    df = documents(spark, rows).selectExpr("*", "'x' as IDS")
    done = pieces.decode(pieces.encode(df))
    got = done.collect()
    assert len(got) == len(rows) and all(r["decoded"] == r["text"] for r in got)
    assert all((r["ids"] is None) == (r["text"] is None) for r in got)
    again = {r["doc_id"]: r["ids"] for r in pieces.encode(df.repartition(7)).collect()}
    assert all(again[r["doc_id"]] == r["ids"] for r in got)
    other = {r["doc_id"]: r["ids"] for r in pieces.encode(df, seed=1).collect()}
    assert any(other[r["doc_id"]] != r["ids"] for r in got)
    assert pieces.encode(df.limit(0)).count() == 0


def test_samples_follow_the_lattice(vocabulary):
    """Frequencies of sampled segmentations against probabilities from full enumeration."""
    word = " tests"

    def all_ways(s):
        if not s:
            yield (), 0.0
        for n in range(1, len(s) + 1):
            hit = vocabulary.potential.get(s[:n])
            if hit:
                for rest, w in all_ways(s[n:]):
                    yield (hit[0], *rest), hit[1] + w

    weights = {ids: math.exp(0.5 * w) for ids, w in all_ways(word)}
    total, n = sum(weights.values()), 40_000
    drawn = pieces.Sampler(vocabulary, 0.5).sample([word[1:]] * n, np.arange(n, dtype=np.uint64))
    seen = Counter(tuple(x.tolist()) for x in drawn)
    assert set(seen) <= set(weights)
    for ids, w in weights.items():
        p = w / total
        assert abs(seen[ids] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_batches_change_nothing(vocabulary):
    keys = np.arange(len(TEXTS), dtype=np.uint64)
    sampler = pieces.Sampler(vocabulary)
    whole = sampler.sample(TEXTS, keys)
    for i, t in enumerate(TEXTS):
        assert np.array_equal(whole[i], sampler.sample([t], keys[i:i + 1])[0])


def test_thresholds_are_the_same_bits_in_any_batch(vocabulary):
    """The drawn edges' cumulative shares of a word depend on nothing but the word."""
    rng = np.random.default_rng(8)
    letters = list("etaoinshrdlu")
    words = [" " + "".join(rng.choice(letters, size=int(n))) for n in rng.integers(2, 14, size=3000)]
    table = pieces.PieceTable(vocabulary)

    def lattice(some):
        chars = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32).astype(np.uint64)
        sizes = np.array([len(w) for w in some])
        return pieces.Lattice(chars, np.cumsum(sizes) - sizes, sizes, table, vocabulary, 1.0)

    def shares(x, word):
        """Thresholds of the edges of a word's last node and of every node before it."""
        out, todo, known = [], [x.ends[word]], set()
        while todo:
            node = todo.pop()
            if node in known or node == 0:
                continue
            known.add(node)
            lo = x.first[node]
            hi = x.first[node + 1] if node + 1 < len(x.first) else len(x.until)
            out.append(tuple(x.until[lo:hi].tolist()))
            todo += x.back[lo:hi].tolist()
        return sorted(out)

    whole = lattice(words)
    for i in rng.choice(len(words), size=150, replace=False):
        assert shares(whole, i) == shares(lattice([words[i]]), 0)


def test_equal_hashes_do_not_mix_words(vocabulary, monkeypatch):
    """With powers of one, anagrams hash alike; comparing characters keeps them apart."""
    ones = [np.ones(10_000, np.uint64)] * 2
    keys, texts = np.arange(2, dtype=np.uint64), ["stop post tops", "abc cab a b"]
    want = pieces.Sampler(vocabulary).sample(texts, keys)
    monkeypatch.setattr(pieces, "powers", lambda n: ones)
    assert all(np.array_equal(a, b) for a, b in zip(want, pieces.Sampler(vocabulary).sample(texts, keys), strict=True))


def test_query_is_lossless(spark, sf_dir):
    from tumbleweed.llm.queries import QUERIES

    df = QUERIES["op4_sentencepiece"](spark, sf_dir)
    rows = df.select("doc_id", "n_tokens", "lossless").collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count() and all(r["lossless"] for r in rows)
