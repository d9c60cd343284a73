"""Blocks of vectors against blocks of queries: what both vector searches share.

Rows are reduced to *classes* of equal vectors first.  A class keeps its ``keep``
smallest ids, which is all that a top-``k`` with ties to the smaller id can
return of it (``keep = k + 1``: the query itself may be among them), so a vector
that many rows repeat costs one class and never gathers in one task.

Classes are dealt into blocks by a hash of their id, query classes into chunks;
each (block, chunk) pair is one bounded unit of work of ``cogroup``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tumbleweed.llm.common import blocks_for, quoted

BLOCK_ROWS = 16384
CHUNK_ROWS = 2048


def usable(df: DataFrame, vec_id: str, vec: str, nonzero: bool) -> DataFrame:
    """``(vec_id, vec array<double>)`` of the rows that take part, one row an id.

    Left out: null ids; vectors that are null, empty, hold null or non-finite
    components, or (``nonzero``) only zeros; vectors whose length is not the
    most frequent one (the smaller of equally frequent ones).  Of several vectors
    under one id the least in order counts.
    """
    v = df.select(quoted(vec_id).cast("long").alias("vec_id"), quoted(vec).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    v = v.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & finite)
    if nonzero:
        v = v.where(F.exists("vec", lambda x: x != 0.0))
    sizes = v.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return v.where(F.size("vec") == (sizes[0]["d"] if sizes else 0)).groupBy("vec_id").agg(F.min("vec").alias("vec"))


def classes_of(vectors: DataFrame, keep: int) -> DataFrame:
    """``(cid, ids, vec)``: distinct vectors with their ``keep`` smallest ids; ``cid`` is the smallest."""
    order = Window.partitionBy("vec").orderBy("vec_id")
    return (vectors.withColumn("n", F.row_number().over(order)).where(F.col("n") <= keep)
            .groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
            .select(F.element_at("ids", 1).alias("cid"), "ids", "vec"))


def query_classes(vectors: DataFrame, classes: DataFrame, every: int) -> DataFrame:
    """``(query_id, cid)`` of every vector whose id is divisible by ``every``."""
    q = vectors.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vec")
    return q.join(classes.select("cid", "vec"), "vec").select("query_id", "cid")


def deal(classes: DataFrame, queries: DataFrame, n_classes: int, n_queries: int,
         block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS):
    """Both sides keyed by ``(block, chunk)``: each class meets each query once."""
    blocks, chunks = blocks_for(n_classes, block_rows), blocks_for(n_queries, chunk_rows)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = (classes.withColumn("block", F.expr(f"cast(pmod(xxhash64(cid), {blocks}) as int)"))
            .withColumn("chunk", every(chunks)))
    # aliases: queries come from the classes, and a cogroup needs columns of its own on each side
    right = (queries.select(*[F.col(c).alias(c) for c in queries.columns]).withColumn("chunk", F.expr(f"cast(pmod(xxhash64(cid, 'q'), {chunks}) as int)"))
             .withColumn("block", every(blocks)))
    return left.groupBy("block", "chunk"), right.groupBy("block", "chunk")


def per_pair(left, right, fn: Callable[[pd.DataFrame, pd.DataFrame], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """``fn(classes, queries)`` for each (block, chunk) that has both; its frames are concatenated."""
    columns = [c.split()[0] for c in schema.split(",")]

    def run(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        parts = list(fn(c, q)) if len(c) and len(q) else []
        return pd.concat(parts) if parts else pd.DataFrame({k: [] for k in columns})

    return left.cogroup(right).applyInPandas(run, schema)


def matrix(column: pd.Series, dtype=np.float64) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(dtype, copy=False)


def answers(queries: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` from ``found (qcid, vec_id, score)``.

    ``found`` holds at least the best ``k + 1`` ids of each query class; a query's
    own id is taken out of its class's list, the first ``k`` of the rest remain.
    """
    order = Window.partitionBy("qcid").orderBy(F.desc("score"), "vec_id")
    best = (found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
            .groupBy("qcid").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("hits")))
    kept = F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("query_id")), 1, k)
    return (queries.join(best.withColumnRenamed("qcid", "cid"), "cid")
            .select("query_id", F.posexplode(kept).alias("at", "hit"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                    F.col("hit.score").alias("score")))
