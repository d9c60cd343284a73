"""Helpers the operators share: table access, lineage cuts, column names."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tumbleweed.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows in a partition of a table of short rows.
PARTITION_ROWS = 250_000


def by_rows(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in as many partitions as ``rows`` short rows need, if it has more.

    A shuffle's files are one for each partition before it: links and labels are
    few against the documents, and would otherwise leave files of a few bytes.
    """
    return df.coalesce(max(1, math.ceil(rows / PARTITION_ROWS)))


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder.

    The rows are then read from storage that every executor shares, so a lost
    executor costs a re-read and not the whole job before it.  Spark drops the
    files once the frame is no longer referenced
    (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns that an operator is about to add (names compare without case)."""
    lowered = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in lowered])


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def blocks_for(rows: int, per_block: int) -> int:
    return max(1, math.ceil(rows / per_block))


def computed(c: Column) -> Column:
    """``c``, computed once.

    A projected expression is copied into filters and lambdas above it, which
    would split a text anew for each of its words.  A one-element ``explode``
    is a step that the optimiser doesn't look through.
    """
    return F.explode(F.array(c))
