"""Connected components of a link table, by alternating star contractions.

Each round replaces every link by links to the least neighbour seen from the
larger end, then from the smaller end, until all links point from a document to
the least document of its component.  Every step is a grouped minimum (combined
before its shuffle) and a join, so no neighbourhood is gathered anywhere; a hub
costs its number of links.  Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tumbleweed.llm.common import by_rows, cut


def _state(links: DataFrame) -> tuple:
    r = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r["n"], r["x"]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node that some link names; a component's name is its least node.

    Self-links and repeated links do no harm; an empty table gives no rows.
    """
    star = cut(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    before = _state(star)
    small_enough = lambda df: by_rows(df, before[0])
    star = small_enough(star)
    while before[0]:
        # from the larger end: every larger neighbour of u points to the least of u and its neighbours
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = small_enough(both.where("v > u").join(least, F.col("u") == F.col("c"))
                             .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"))
        # from the smaller end: u and its smaller neighbours point to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        star = small_enough(cut(small_enough(small.unionByName(low.select("u", F.col("m").alias("v")))).distinct()))
        after = _state(star)
        if after == before:
            break
        before = after
    return (star.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
            .unionByName(star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
