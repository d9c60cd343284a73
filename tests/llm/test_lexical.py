"""Ranked lexical search: NRA against scores of every document."""

import math
import re
from collections import Counter

import numpy as np
from llm_helpers import documents

from tumbleweed.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(x for _, c in counted for x in c)
    asked = {}
    for item, t in items:
        if item is not None:
            asked.setdefault(item, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        found = []
        for i, c in counted:
            m = 100 - 90 + (90 * c.total() * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10**9 * c[x]) // (1000 * c[x] + 8 * m)) for x in wanted if x in c)
            if s > 0 and i is not None:
                found.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


def answers(spark, docs, items, **options):
    found = lexical.search(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"), **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(tuple(r) for r in found.collect())


def random_table(seed, n=120):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(40)] + ["Äpfel", "A1", "x_y", "naïve"]
    p = 1 / np.arange(1, len(words) + 1)
    text = lambda size: " ".join(rng.choice(words, size=size, p=p / p.sum()))
    docs = [(i, text(int(rng.integers(1, 60)))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "?! "), (None, "w1 w2 w3"), (5, docs[5][1]), (n + 3, docs[7][1])]
    return docs, [(i, text(6)) for i in range(15)] + [(99, None), (98, "unknownword"), (None, "w1"), (3, "w39"), (97, "")]


def test_nra_finds_all_that_can_be_among_the_best():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n, k = int(rng.integers(1, 60)), int(rng.integers(1, 12))
        lists = []
        for _t in range(int(rng.integers(0, 6))):
            docs = rng.choice(n, size=int(rng.integers(0, n + 1)), replace=False)
            x = np.sort(rng.integers(0, int(rng.choice([3, 50, 10**9])), size=len(docs)))[::-1].astype(np.int64)
            lists.append((docs, x))
        full = np.zeros(n, dtype=np.int64)
        for d, x in lists:
            full[d] += x
        floor = int(rng.choice([0, 0, np.median(full)]))
        found, scores = lexical.nra(lists, n, k, floor)
        assert (full[found] == scores).all() and len(set(found.tolist())) == len(found)
        best = sorted((-s, d) for d, s in enumerate(full.tolist()) if s > 0 and s >= floor)[:k]
        assert best == sorted(zip((-scores).tolist(), found.tolist()))[:k]


def test_nra_stops_early():
    class Read:
        """A list that notes how far it was read."""
        def __init__(self, docs):
            self.docs, self.far = docs, 0

        def __getitem__(self, s):
            self.far = max(self.far, s.stop)
            return self.docs[s]

    n = 1000
    rng = np.random.default_rng(2)
    lists = [(Read(rng.permutation(n)), np.sort(rng.integers(1, 1000, n)).astype(np.int64)[::-1].copy()) for _ in range(2)]
    for docs, x in lists:
        docs.docs = np.concatenate([[7], docs.docs[docs.docs != 7]])
        x[0] = 1 << 40
    found, scores = lexical.nra(lists, n, 1)
    assert found.tolist() == [7] and scores.tolist() == [1 << 41]
    assert max(d.far for d, _ in lists) < 10


def test_search_equals_brute_force(spark):
    docs, items = random_table(3)
    want = brute(docs, items, 10)
    assert answers(spark, docs, items) == want
    # many small blocks with a running floor, and items in several vocabularies
    assert answers(spark, docs, items, block=50, vocabulary=20) == want
    assert answers(spark, docs, items, k=1) == brute(docs, items, 1)


def test_ties_repeats_and_empty_tables(spark):
    docs = [(i, "same words here") for i in (9, 4, 4, 7, 2)] + [(1, "other")]
    items = [(1, "same here"), (1, "WORDS")]
    got = answers(spark, docs, items, k=3)
    assert got == brute(docs, items, 3) and [r[2] for r in got] == [2, 4, 4]
    assert answers(spark, [], items) == [] and answers(spark, docs, []) == []


def test_long_texts_are_read_in_parts(spark):
    text = " ".join(f"t{i % 997}" for i in range(300_000))
    assert len(text) > lexical.PIECE
    assert lexical.term_counts(text.encode()) == Counter(w.encode() for w in text.split(" "))
    solid = b"x" * (3 << 20)
    assert lexical.term_counts(solid + b" y") == {solid: 1, b"y": 1}
    docs, items = [(1, text), (2, "t5 t6")], [(1, "t5 t900")]
    assert answers(spark, docs, items) == brute(docs, items, 10)


def test_large_lengths_use_whole_numbers():
    n = np.array([1, 10**9], dtype=np.int64)
    assert lexical.length_factor(n, 10**11, 10**13).tolist() == [10 + 90 * int(x) * 10**11 // 10**13 for x in n]


def test_clashing_columns(spark):
    docs, items = random_table(4, 20)
    wide = documents(spark, docs).selectExpr("*", "1 AS n", "2 AS terms", "3 AS score", "4 AS item_id")
    got = lexical.search(wide, spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id"))
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, items, 10)
