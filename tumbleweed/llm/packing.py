"""Packing into optimal length buckets.

Sequences longer than ``max_len`` tokens are cut into segments of ``max_len`` and
a rest, so nothing is dropped.  The histogram of segment lengths over all rows has
``max_len`` entries at most, whatever the corpus; on it, dynamic programming
chooses the ``buckets`` upper bounds that minimise the total padding when every
segment is padded to its bucket's bound.  Inside each bucket, segments form
batches of ``budget // bound`` rows: ``budget`` tokens, padding included.

Batches are numbered without gathering a bucket: rows are numbered inside
(bucket, input partition), and each partition starts where the counts of those
before it end.  Only the last batch of a bucket can be short.

Lengths are UTF-8 bytes (a byte-level vocabulary) unless ``length`` names a column
of token counts.

Defined cases: a null or empty sequence has one segment of length 0 and no
bucket, batch or slot; repeated rows are each packed; extra columns stay out of
the plan; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tumbleweed.llm.common import cut, quoted

MAX_LEN = 8192
BUCKETS = 16
BUDGET = 131072


def bucket_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least total padding.

    ``least[j]``: the least padded total of the ``j`` shortest lengths in the
    buckets so far; a further bucket from ``i`` to ``j`` costs
    ``lengths[j - 1]`` for every segment in it.  Integers throughout.
    """
    order = np.argsort(lengths)
    length, upto = lengths[order].astype(np.int64), np.concatenate([[0], np.cumsum(counts[order].astype(np.int64))])
    m = len(length)
    if not m:
        return []
    never = np.iinfo(np.int64).max // 4
    least = np.full(m + 1, never)
    least[0] = 0
    choice = []
    for _ in range(min(buckets, m)):
        following, start = np.full(m + 1, never), np.zeros(m + 1, np.int64)
        for at in range(1, m + 1, 256):
            j = np.arange(at, min(at + 256, m + 1))
            cost = least[None, :j[-1]] + length[j - 1, None] * (upto[j, None] - upto[None, :j[-1]])
            cost = np.where(np.arange(j[-1])[None, :] < j[:, None], cost, never)
            start[j] = cost.argmin(axis=1)
            following[j] = cost[np.arange(len(j)), start[j]]
        least = following
        choice.append(start)
    bounds, j = [], m
    for start in reversed(choice):
        bounds.append(int(length[j - 1]))
        j = int(start[j])
        if not j:
            break
    return bounds[::-1]


def segments(docs: DataFrame, doc_id: str, text: str, length: str | None, max_len: int) -> DataFrame:
    tokens = quoted(length) if length else F.octet_length(quoted(text).cast("string"))
    size = F.greatest(F.coalesce(tokens.cast("long"), F.lit(0)), F.lit(0)).cast("long")
    return (docs.select(quoted(doc_id).alias("doc_id"), size.alias("size"))
            .withColumn("segment", F.explode(F.expr(f"sequence(0, cast(greatest(ceil(size / {max_len}), 1) - 1 as int))")))
            .select("doc_id", "segment", (F.col("segment").cast("long") * max_len).alias("start"),
                    F.least(F.col("size") - F.col("segment").cast("long") * max_len, F.lit(max_len)).alias("length")))


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: str | None = None, max_len: int = MAX_LEN,
         buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """One row per segment: ``doc_id, segment, start, length, bucket, padded, batch, slot``."""
    if budget < max_len:
        raise ValueError("a batch must hold the longest segment")
    # written once: row order and partitions, which the numbering rests on, stay as they are
    parts = cut(segments(docs, doc_id, text, length, max_len))
    hist = parts.where("length > 0").groupBy("length").count().collect()
    bounds = bucket_bounds(np.array([r["length"] for r in hist], np.int64), np.array([r["count"] for r in hist], np.int64), buckets)
    bound = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<long>")
    fits = F.filter(bound, lambda b: b >= F.col("length"))
    placed = (parts.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33))
              .withColumn("padded", F.when(F.col("length") > 0, F.try_element_at(fits, F.lit(1))))
              .withColumn("bucket", F.when(F.col("length") > 0, F.lit(len(bounds)) - F.size(fits))))
    full = placed.where("bucket is not null")
    sizes = full.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    offsets = sizes.select("bucket", "part", (F.sum("n").over(Window.partitionBy("bucket").orderBy("part")) - F.col("n")).alias("offset"))
    number = F.row_number().over(Window.partitionBy("bucket", "part").orderBy("at"))
    rows = F.greatest(F.expr(f"{budget} div padded"), F.lit(1))
    numbered = (full.withColumn("n", number).join(offsets, ["bucket", "part"])
                .withColumn("n", F.col("n") - 1 + F.col("offset")).withColumn("rows", rows))
    columns = ["doc_id", "segment", "start", "length", "bucket", "padded"]
    return (numbered.select(*columns, F.expr("n div rows").alias("batch"), F.expr("cast(n % rows as int)").alias("slot"))
            .unionByName(placed.where("bucket is null").select(*columns, F.lit(None).cast("long").alias("batch"), F.lit(None).cast("int").alias("slot"))))
