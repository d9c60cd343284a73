"""Exact top-k search by distributed histogram selection.

Every query is scored against every vector, block by block, several times over;
scores are never stored.  Each round narrows, for each query, the range that
holds its k-th largest score: blocks count scores per histogram bin, the counts
are summed over all blocks, and the bin in which the running count from above
reaches k becomes the next range.  When a bin is one integer wide, the k-th
value is known exactly; a last pass keeps what lies above it and, of the scores
equal to it, the smallest ids.

A block reports bins from its own top down to where its own count reaches k: the
global k-th value is never below a block's k-th, so counts at and above the
global bin are complete, and a report has at most k bins.

Defined cases: see ``vectors.usable``; with fewer than k candidates all are
returned; an empty table gives no rows; a score beyond 64 bits (as of a very large
vector with itself) counts as the nearest number of 64 bits; a component beyond 64
bits fails the job.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tumbleweed.llm import vectors as V
from tumbleweed.llm.common import cut

BINS = 4096
QUERY_STEP = 128


def scores_of(queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Integer inner products, exact: in doubles while every partial sum stays below 2**53.

    Larger ones are taken modulo 2**64, which is exact for every score that has 64
    bits, whatever its partial sums; the scores that doubles can't show to be
    in range are added up one by one, and cut off there.
    """
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(block).max(initial=0)) * block.shape[1]
    near = queries.astype(np.float64) @ block.astype(np.float64).T
    if most < 2**53:
        return near.astype(np.int64)
    exact = queries @ block.T  # wraps around
    if most >= 2**62:
        slack = (np.abs(queries.astype(np.float64)) @ np.abs(block.astype(np.float64)).T) * (block.shape[1] + 2) * 2.0**-52
        for i, j in zip(*np.nonzero(np.abs(near) + slack >= 2**63), strict=True):
            exact[i, j] = min(max(sum(int(x) * int(y) for x, y in zip(queries[i], block[j], strict=True)), -2**63), 2**63 - 1)
    return exact


def _steps(c: pd.DataFrame, q: pd.DataFrame):
    block = V.matrix(c["vec"], np.int64)
    for at in range(0, len(q), QUERY_STEP):
        part = q.iloc[at:at + QUERY_STEP]
        yield part, scores_of(V.matrix(part["vec"], np.int64), block)


def _histogram(k: int, width: int):
    """Counts per bin of each query's range ``[lo, lo + width * BINS)``; bins below a block's own k-th are left out."""
    def fn(c, q):
        weight = np.minimum(c["ids"].map(len).to_numpy(), k)
        for part, scores in _steps(c, q):
            out = []
            for qcid, lo, row in zip(part["cid"], part["lo"], scores, strict=True):
                inside = row >= lo
                # a score above the range counts in the last bin's successor, whose ids are known to be needed
                above = row[inside].view(np.uint64) - np.array([lo], dtype=np.int64).view(np.uint64)  # up to 2**64 - 1
                bins = np.minimum(above // np.uint64(width), np.uint64(BINS)).astype(np.int64)
                values, where = np.unique(bins, return_inverse=True)
                counts = np.bincount(where, weights=weight[inside]).astype(np.int64)
                values, counts = values[::-1], counts[::-1]
                n = int(np.searchsorted(np.cumsum(counts), k)) + 1
                out.append(pd.DataFrame({"qcid": qcid, "bin": values[:n], "n": counts[:n]}))
            yield pd.concat(out)
    return fn


def _winners(k: int):
    """Ids above the k-th value, and the smallest ids at it."""
    def fn(c, q):
        ids, first = c["ids"].to_numpy(), c["cid"].to_numpy()
        for part, scores in _steps(c, q):
            for qcid, kth, row in zip(part["cid"], part["lo"], scores, strict=True):
                ties = np.flatnonzero(row == kth)
                ties = ties[np.argsort(first[ties])][:k]
                hit = np.concatenate([np.flatnonzero(row > kth), ties])
                if len(hit):
                    yield pd.DataFrame({"qcid": qcid, "vec_id": np.concatenate(list(ids[hit])),
                                        "score": np.repeat(row[hit], [len(x) for x in ids[hit]])})
    return fn


def top_k(df: DataFrame, k: int, every: int, vec_id: str = "vec_id", vec: str = "embedding", scale: int = 1024,
          block_rows: int = V.BLOCK_ROWS, chunk_rows: int = V.CHUNK_ROWS) -> DataFrame:
    """The ``k`` best rows of each row whose id is divisible by ``every``, by inner product of ``floor(scale * x)``."""
    usable = V.usable(df, vec_id, vec, nonzero=False)
    whole = cut(usable.select("vec_id", F.transform("vec", lambda x: F.floor(x * F.lit(float(scale)))).alias("vec")))
    classes = cut(V.classes_of(whole, k + 1))
    queries = cut(V.query_classes(whole, classes, every))
    distinct = queries.select("cid").distinct().join(classes.select("cid", "vec"), "cid")
    sizes = classes.agg(F.count("*").alias("n"), F.max(F.expr("aggregate(vec, 0D, (a, x) -> a + double(x) * double(x))")).alias("square")).first()
    n_queries = distinct.count()
    if not sizes["n"] or not n_queries:
        return queries.select("query_id", F.lit(0).alias("rank"), F.col("cid").alias("vec_id"), F.col("cid").alias("score")).limit(0)
    bound = min(int(sizes["square"] * (1 + 1e-9)) + 1, 2**63)  # |a . b| <= max |a|**2
    width, need = 1, k + 1
    while width * BINS < 2 * bound + 1:
        width *= BINS
    state = distinct.withColumn("lo", F.lit(-bound).cast("long"))
    while True:
        left, right = V.deal(classes, state.select("cid", "vec", "lo"), sizes["n"], n_queries, block_rows, chunk_rows)
        counts = (V.per_pair(left, right, _histogram(need, width), "qcid long, bin long, n long")
                  .groupBy("qcid", "bin").agg(F.sum("n").alias("n")))
        above = F.sum("n").over(Window.partitionBy("qcid").orderBy(F.desc("bin")))
        # the first bin from above where the count reaches k; the lowest bin there is, if it never does
        reached = (counts.withColumn("above", above).groupBy(F.col("qcid").alias("cid"))
                   .agg(F.coalesce(F.max(F.when(F.col("above") >= need, F.col("bin"))), F.min("bin")).alias("bin")))
        state = cut(state.join(reached, "cid")
                    .select("cid", "vec", F.expr(f"cast(lo + cast(bin AS decimal(20,0)) * cast({width} AS decimal(20,0)) AS bigint)").alias("lo")))
        if width == 1:
            break
        width //= BINS
    left, right = V.deal(classes, state, sizes["n"], n_queries, block_rows, chunk_rows)
    found = V.per_pair(left, right, _winners(need), "qcid long, vec_id long, score long")
    return V.answers(queries, found, k)
