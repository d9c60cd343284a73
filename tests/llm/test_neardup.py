"""Near copies against brute force over exact shingle sets."""

import random

import numpy as np
import pytest

from llm_helpers import documents

from tumbleweed.llm import neardup
from tumbleweed.llm.components import components
from tumbleweed.llm.queries import QUERIES
from tumbleweed.llm.words import shingle_set, word_hashes

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def exact_set(text, n):
    w = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, n):
    sets = {i: exact_set(t, n) for i, t in rows}
    name = {i: i for i in sets}

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= 80 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                p, q = root(i), root(j)
                name[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), root(i)) for i in ids}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def varied(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"x{rng.random()}"
    return " ".join(out)


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = [(i, varied(rng, base, rng.randrange(0, 14))) for i in range(120)]  # a group of near copies around the threshold
    rows += [(200 + i, " ".join(base)) for i in range(60)]  # exact copies
    rows += [(300, None), (301, ""), (302, " \t\n"), (303, "one"), (304, "ONE"), (305, "two words"), (306, "Two\tWORDS"), (307, "É"), (308, "é")]
    rows += [(400 + i, " ".join(f"u{rng.randrange(10**9)}" for _ in range(40)) + " " + " ".join(base[:25])) for i in range(40)]  # a shared passage
    rows += [(500, "long " * 400_000), (501, "x" * 3_000_000)]
    return rows


@pytest.mark.parametrize("ngram", [2, 5])
def test_components_equal_brute_force(spark, odd_rows, ngram):
    assert result(neardup.link_components(documents(spark, odd_rows), ngram=ngram)) == brute(odd_rows, ngram)


def test_cells_alone_find_all_links(spark, odd_rows, monkeypatch):
    """Small cells, over several parts of a bucket."""
    monkeypatch.setattr(neardup, "CELL_ROWS", 16)
    rows = odd_rows[:120]
    assert result(neardup.link_components(documents(spark, rows), ngram=2)) == brute(rows, 2)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert result(QUERIES["op5_near_dup"](spark, sf_dir)) == brute(rows, 2)


def test_odd_tables(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = documents(spark, [(3, text), (3, text), (1, text), (None, text), (None, None)]).selectExpr("*", "1 as digest", "'a' as bands", "2 as component")
    got = sorted((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in neardup.link_components(df).collect())
    assert got == [(-1, None, True), (-1, None, True), (1, 1, True), (3, 1, False), (3, 1, False)]
    kept = neardup.drop_copies(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, -1, 1]
    assert neardup.link_components(df.limit(0)).count() == 0 and neardup.drop_copies(df.limit(0)).count() == 0


def test_word_hashes_follow_the_definition():
    texts = ["A b\x0bC\x1fd  e\n", "", "É é", "a" * 2_500_000 + " b", ("word " * 300_000)]
    for t in texts:
        words = t.encode().translate(LOWER).split()
        hashes = word_hashes([t.encode()])[0]
        assert len(hashes) == len(words) and len(set(hashes.tolist())) == len(set(words))
    a, b = word_hashes([b"x y z", b"z X Y"])
    assert a[0] == b[1] and a[2] == b[0]
    assert len(shingle_set(a, 5)) == 1 and len(shingle_set(a, 2)) == 2


def test_odd_sketches_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, size=2000).astype(np.uint64)
    for common, low, high in ((1000, 0, 0), (900, 20, 75), (500, 97, 512)):
        a, b = np.sort(pool[:1000]), np.sort(pool[1000 - common:2000 - common])
        x, y = (neardup.odd_sketches(np.array([neardup.minhash(s)])).view(np.uint64) for s in (a, b))
        assert low <= np.bitwise_count(x ^ y).sum() <= high


def test_intersections_in_slices():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 300, size=n)).astype(np.uint64) for n in (5, 80, 0, 200)]
    got = neardup.common_counts(sets, sets[::-1], width=32)
    assert got.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[::-1]] for a in sets]


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(50, 90)] + [(7, x) for x in range(100, 140)] + [(3, 7), (3, 3), (3, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 50 for i in range(50, 91)}, **{i: 3 for i in (3, 7, *range(100, 140))}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
