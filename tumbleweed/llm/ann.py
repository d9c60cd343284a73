"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

*Codes.*  Vectors are centred and turned by learned rotations (iterative
quantisation: alternate signs and an orthogonal Procrustes fit, on a bounded
sample of ``fit_rows`` classes); the signs are the code.  Where a code is longer
than the vectors, several rotations from different starts are joined.

*Index.*  A code is split into ``substrings`` parts; each block of the index has
one bucket directory per part.  By the pigeonhole principle a code within
``radius`` of the query's differs in some part ``i`` by at most ``t_i`` bits,
where the ``t_i + 1`` add up to ``radius + 1``; probing every value within ``t_i``
of the query's part ``i`` therefore retrieves *every* code within the radius.
Retrieved codes are checked by their full distance and reranked by the inner
product of the original vectors in double precision.

*Radius.*  Chosen from the data: ``probe_rows`` sampled vectors are searched
exactly against all classes (a scan, linear in the table), and the radius is the
``target`` quantile of the code distances to their true neighbours.  That keeps
recall where it is wanted at every table size.  A block with too few codes
inside the radius adds its nearest codes, so each query gets ``k`` rows.

Defined cases: see ``vectors.usable``; fewer than ``k`` candidates are all
returned; an empty table gives no rows.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tumbleweed.llm import vectors as V
from tumbleweed.llm.common import cut

PART_BITS = 16


def learn_rotations(sample: np.ndarray, bits: int, rounds: int = 30, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Centre and a ``d x bits`` projection."""
    rng = np.random.default_rng(seed)
    mean = sample.mean(axis=0)
    x = sample - mean
    d = x.shape[1]
    basis = np.linalg.eigh(np.cov(x.T).reshape(d, d))[1][:, ::-1][:, :min(bits, d)] if len(x) > 1 else np.eye(d)[:, :min(bits, d)]
    y = x @ basis
    turned = []
    for _ in range(ceil(bits / y.shape[1])):
        r = np.linalg.qr(rng.normal(size=(y.shape[1], y.shape[1])))[0]
        for _ in range(rounds):
            u, _, w = np.linalg.svd(np.where(y @ r >= 0, 1.0, -1.0).T @ y)
            r = (u @ w).T
        turned.append(basis @ r)
    return mean, np.concatenate(turned, axis=1)[:, :bits]


def encode(x: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Codes as rows of unsigned 16-bit parts."""
    return np.packbits((x - model[0]) @ model[1] >= 0, axis=1).view(np.uint16)


def distances(code: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ code).sum(axis=1)


def thresholds(radius: int, parts: int) -> list[int]:
    """``t_i`` with ``sum(t_i + 1) = radius + 1``, as even as can be; -1 probes nothing."""
    whole, more = divmod(radius + 1, parts)
    return [whole - 1 + (i < more) for i in range(parts)]


def _masks() -> tuple[np.ndarray, np.ndarray]:
    """All values of a part by number of bits, and where each number's values end."""
    values = np.arange(1 << PART_BITS, dtype=np.uint16)
    n = np.bitwise_count(values)
    order = np.argsort(n, kind="stable")
    return values[order], np.searchsorted(n[order], np.arange(PART_BITS + 1), side="right")


class Directory:
    """Bucket directories of one block: for each part, rows sorted by value and where each value starts."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.masks, self.ends = _masks()
        self.rows = [np.argsort(codes[:, i], kind="stable") for i in range(codes.shape[1])]
        self.starts = [np.searchsorted(codes[r, i], np.arange((1 << PART_BITS) + 1)) for i, r in enumerate(self.rows)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code lies within ``radius``."""
        seen = np.zeros(len(self.codes), dtype=bool)
        for i, t in enumerate(thresholds(radius, len(code))):
            if t < 0:
                continue
            probes = (self.masks[:self.ends[min(t, PART_BITS)]] ^ code[i]).astype(np.int64)
            first, last = self.starts[i][probes], self.starts[i][probes + 1]
            full = last > first
            first, n = first[full], (last - first)[full]
            if len(n):
                at = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                seen[self.rows[i][at]] = True
        rows = np.flatnonzero(seen)
        return rows[distances(code, self.codes[rows]) <= radius]


def _search(need: int, radius: int):
    def fn(c, q):
        block, codes = V.matrix(c["vec"]), np.stack([np.frombuffer(x, np.uint16) for x in c["code"]])
        ids, first = c["ids"].to_numpy(), c["cid"].to_numpy()
        index = Directory(codes)
        for qcid, vec, raw in zip(q["cid"], q["vec"], q["code"], strict=True):
            code = np.frombuffer(raw, np.uint16)
            rows = index.within(code, radius)
            if len(rows) < need:
                d = distances(code, codes)
                rows = np.argpartition(d, need - 1)[:need] if len(d) > need else np.arange(len(d))
            scores = (block[rows] * np.asarray(vec)).sum(axis=1)
            best = np.lexsort((first[rows], -scores))[:need]
            hit = rows[best]
            yield pd.DataFrame({"qcid": qcid, "vec_id": np.concatenate(list(ids[hit])),
                                "score": np.repeat(scores[best], [len(x) for x in ids[hit]])})
    return fn


def _sample(classes: DataFrame, n: int, salt: str) -> list:
    """A bounded, repeatable sample: the ``n`` classes whose hashed ids come first."""
    return classes.select("cid", "vec").orderBy(F.xxhash64("cid", F.lit(salt)), "cid").limit(n).collect()


def calibrate(coded: DataFrame, model, sample: list, k: int, target: float) -> int:
    """The ``target`` quantile of code distances between sampled vectors and their true ``k`` nearest."""
    ids = np.array([r["cid"] for r in sample])
    x = np.array([r["vec"] for r in sample])
    own = encode(x, model)

    def scan(frames):
        for f in frames:
            block, codes, cids = V.matrix(f["vec"]), np.stack([np.frombuffer(c, np.uint16) for c in f["code"]]), f["cid"].to_numpy()
            scores = x @ block.T
            for i, row in enumerate(scores):
                row = np.where(cids == ids[i], -np.inf, row)
                top = np.argpartition(-row, k - 1)[:k] if len(row) > k else np.arange(len(row))
                yield pd.DataFrame({"i": i, "score": row[top], "d": distances(own[i], codes[top])})

    order = Window.partitionBy("i").orderBy(F.desc("score"), "d")
    near = (coded.mapInPandas(scan, "i long, score double, d long").where(F.col("score") > float("-inf"))
            .withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).select("d").collect())
    return int(np.quantile([r["d"] for r in near], target, method="higher")) if near else 0


def search(df: DataFrame, k: int, every: int, vec_id: str = "vec_id", vec: str = "embedding", bits: int = 128,
           fit_rows: int = 4096, probe_rows: int = 128, target: float = 0.97,
           block_rows: int = V.BLOCK_ROWS, chunk_rows: int = V.CHUNK_ROWS) -> DataFrame:
    """The ``k`` nearest found (largest inner product) of each row whose id is divisible by ``every``."""
    if bits % PART_BITS:
        raise ValueError(f"bits must be a multiple of {PART_BITS}")
    usable = cut(V.usable(df, vec_id, vec, nonzero=True))
    classes = cut(V.classes_of(usable, k + 1))
    queries = cut(V.query_classes(usable, classes, every))
    sample = _sample(classes, fit_rows, "fit")
    if not sample:
        return queries.select("query_id", F.lit(0).alias("rank"), F.col("cid").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    model = learn_rotations(np.array([r["vec"] for r in sample]), bits)

    @F.pandas_udf("binary")
    def code(v: pd.Series) -> pd.Series:
        return pd.Series([row.tobytes() for row in encode(V.matrix(v), model)])

    coded = cut(classes.withColumn("code", code("vec")))
    radius = calibrate(coded, model, _sample(classes, probe_rows, "probe"), k, target)
    wanted = cut(queries.select("cid").distinct().join(coded.select("cid", "vec", "code"), "cid"))
    left, right = V.deal(coded, wanted, coded.count(), wanted.count(), block_rows, chunk_rows)
    found = V.per_pair(left, right, _search(k + 1, radius), "qcid long, vec_id long, score double")
    return V.answers(queries, found, k)
