"""Cross-tokenizer alignment against overlap components, token by token."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import documents
from pyspark.sql import functions as F

from tumbleweed.llm import alignment
from tumbleweed.llm.queries import QUERIES


@pytest.fixture(scope="module")
def models():
    with open(alignment.MODEL_A, "rb") as f, open(alignment.MODEL_B, "rb") as g:
        return alignment.ByteLevel(f.read()), alignment.Pieces(g.read())


@pytest.fixture(scope="module")
def library_a():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(alignment.MODEL_A)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def overlap_groups(spans_a, spans_b):
    """Components of overlapping byte ranges, by marking every byte."""
    ends = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
    return [([i for i, (s, e) in enumerate(spans_a) if lo <= s and e <= hi], [i for i, (s, e) in enumerate(spans_b) if lo <= s and e <= hi])
            for lo, hi in zip([0, *ends], ends)]


def spans(lengths):
    ends = np.cumsum(lengths).tolist()
    return list(zip([0, *ends], ends))


def brute(rows, models, encode_a):
    a, b = models
    done = []
    for doc, text in rows:
        ids_a, ids_b = (encode_a(" " + text), b.model.encode(text)) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if b.joined(ids_b) != raw or a.joined(ids_a) != raw:
            ids_a = ids_b = []
        groups = overlap_groups(spans([int(a.lengths[i]) for i in ids_a]), spans([len(b.bytes_of[i]) for i in ids_b]))
        named = ";".join(",".join(str(ids_a[i]) for i in x) + "|" + ",".join(str(ids_b[i]) for i in y) for x, y in groups)
        done.append((doc, ids_a, ids_b, [(ids_a[x[-1]], ids_b[y[-1]]) for x, y in groups], named))
    count = Counter(p for r in done for p in r[3])
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return sorted([(doc, len(x), len(y), len(links), len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(named.encode()).hexdigest() if x else "") for doc, x, y, links, named in done], key=str)


def aligned_rows(spark, rows, tmp_path, chunk=alignment.CHUNK, hot_pairs=alignment.HOT_PAIRS, extra=()):
    docs = documents(spark, rows).selectExpr("*", *extra)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    path = str(tmp_path / f"aligned-{chunk}-{hot_pairs}")
    (alignment.align(docs, chunk=chunk).withColumn("groups_sha256", digest).drop("groups")
     .withColumn("row_id", F.monotonically_increasing_id()).write.parquet(path))
    aligned = spark.read.parquet(path)
    out = alignment.count_links(aligned, alignment.link_counts(aligned), "row_id", hot_pairs)
    return sorted([tuple(r) for r in out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()], key=str)


ROWS = [(1, "The quick brown fox, 12345 jumps!"), (2, None), (3, ""), (4, " leading and  double   spaces "), (5, "über naïve 東京 \U0001f600\U0001f600 ok"),
        (6, "literal ▁ mark"), (7, "tags <s> </s> <unk> <|endoftext|> <0x41>"), (8, "line\nbreak\ttab\r\n"), (1, "The quick brown fox, 12345 jumps!"),
        (None, "no id the the the"), (9, "a" * 3000), (10, "\x00\x01 odd"), (11, "a'll 're it's  "), (12, "café ​ x")]


def test_rows_equal_brute_force(spark, models, library_a, tmp_path):
    want = brute(ROWS, models, library_a)
    assert aligned_rows(spark, ROWS, tmp_path) == want
    assert sum(r[1] for r in want if r[0] in (2, 3, 6)) == 0 and all(r[7] == "" for r in want if r[0] in (2, 3, 6))
    # hardly a pair is broadcast, the rest is joined
    assert aligned_rows(spark, ROWS, tmp_path, hot_pairs=3) == want
    # tiny batches; clashing columns stay out
    assert aligned_rows(spark, ROWS, tmp_path, chunk=16, extra=("1 AS n_a", "2 AS pairs", "3 AS row_id", "4 AS groups")) == want


def test_group_labels_equal_components():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 40))
        ends = [np.append(np.sort(rng.choice(np.arange(1, n), size=int(rng.integers(0, n)), replace=False)), n) if n > 1 else np.array([1]) for _ in range(2)]
        la, lb = alignment.group_labels(*ends)
        parent = list(range(len(la) + len(lb)))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        sa, sb = (spans(np.diff(np.append(0, e))) for e in ends)
        for i, (s, e) in enumerate(sa):
            for j, (t, f) in enumerate(sb):
                if s < f and t < e:
                    parent[root(i)] = root(len(sa) + j)
        labels = [*la.tolist(), *lb.tolist()]
        assert len({(labels[i], root(i)) for i in range(len(labels))}) == len(set(labels)) == len({root(i) for i in range(len(labels))})
        assert sorted(set(labels)) == list(range(len(set(labels))))


def test_long_chains_need_few_rounds():
    n = 1 << 16
    ends_a, ends_b = np.arange(2, 2 * n + 2, 2), np.append(np.arange(1, 2 * n, 2), 2 * n)  # interleaved to the very end
    la, lb = alignment.group_labels(ends_a, ends_b)
    assert not la.any() and not lb.any()


def test_cut_texts_tokenize_alike(models):
    rng = np.random.default_rng(5)
    words = ["the", "quick", "x1", "über", "foo,", "it's", "\n", "12", "東京", "  ", "Aa"]
    for _ in range(30):
        text = " ".join(rng.choice(words, size=300))
        assert alignment.tokens(text, *models, chunk=50) == alignment.tokens(text, *models)
        assert " ".join(alignment.pieces_of(text, 50)) == text


def test_ranks_tokenize_as_the_library_does(models, library_a, spark, sf_dir):
    rng = np.random.default_rng(6)
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect() if r["text"]][:60]
    texts += ["".join(chr(int(c)) for c in rng.choice([*range(32, 127), *range(0xC0, 0x180), 0x3042, 0x1F600, 9, 10, 0xA0, 0x2003], size=200)) for _ in range(100)]
    assert all(models[0].encode(t) == library_a(t) for t in texts)


def test_empty_table(spark, tmp_path):
    assert aligned_rows(spark, [], tmp_path) == []


def test_query_equals_brute_force(spark, sf_dir, models, library_a):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_token_alignment"](spark, sf_dir).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    short = [r for r in rows if len(r[1] or "") < 3000]
    a, _ = models
    want = {r[0]: r for r in brute(rows, models, a.encode)} if len(short) == len(rows) else None
    if want is None:  # the brute force is quadratic in a text's length: long ones count links, and are compared by their sums
        fast = {r[0]: r for r in fast_rows(rows, models)}
        assert {r["doc_id"]: tuple(r) for r in got} == fast
    else:
        assert {r["doc_id"]: tuple(r) for r in got} == want


def fast_rows(rows, models):
    """As ``brute``, walking the ends of both tokenizations side by side."""
    a, b = models
    done = []
    for doc, text in rows:
        x, y = (a.encode(" " + text), b.model.encode(text)) if text else ([], [])
        if b.joined(y) != (" " + (text or "")).encode():
            x = y = []
        ends_b = {e: j for j, (_, e) in enumerate(spans([len(b.bytes_of[i]) for i in y]))}
        links, names, i0, j0 = [], [], 0, 0
        for i, (_, e) in enumerate(spans([int(a.lengths[t]) for t in x])):
            if e in ends_b:
                j = ends_b[e]
                links.append((x[i], y[j]))
                names.append(",".join(map(str, x[i0:i + 1])) + "|" + ",".join(map(str, y[j0:j + 1])))
                i0, j0 = i + 1, j + 1
        done.append((doc, len(x), len(y), links, ";".join(names)))
    count = Counter(p for r in done for p in r[3])
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    for doc, n_a, n_b, links, named in done:
        yield (doc, n_a, n_b, len(links), len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links),
               hashlib.sha256(named.encode()).hexdigest() if n_a else "")
