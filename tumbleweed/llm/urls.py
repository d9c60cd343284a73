"""URL filter: a blocked Bloom filter in front of an exact hash join.

A rule is ``(host, path, verdict)``.  It fits its host and every subdomain when
the URL's path starts with the rule's path; the longest fitting rule wins (host
length decides between equal lengths).  A URL that no rule fits gets
``default`` as its verdict.

A fitting rule always equals (some host suffix, some path prefix) of the URL.
Only suffixes and prefixes of the *shapes* that occur among the rules (number of
host labels, length of the path) are formed, so a URL makes at most as many
candidates as there are shapes.  Candidates that the Bloom filter cannot rule
out go to an exact equi-join with the rules, which removes false positives.

The filter (see ``bloom``) has a bounded size; past it more candidates come
through, and the join still gives the same result.  It is the only thing
broadcast by hand.

Defined cases: a null URL or one without ``://`` has an empty host and path and
fits no rule; repeated rows are each answered; columns of the input named like
an output column are replaced.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tumbleweed.llm import bloom
from tumbleweed.llm.common import ascii_lower, quoted, without

OUTPUT = ["host", "path", "rule", "verdict"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + F.lit(1), F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def _key(host: Column, path: Column) -> Column:
    return F.xxhash64(host, path)


def _probe(spark, blocks):
    shared = spark.sparkContext.broadcast(blocks)

    @F.pandas_udf("boolean")
    def maybe(key: pd.Series, bits: pd.Series) -> pd.Series:
        return pd.Series(bloom.may_hold(shared.value, key.to_numpy(), bits.to_numpy()))

    return maybe


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` of every row."""
    spark = pages.sparkSession
    rules = (rules.select("host", "path", "verdict")
             .groupBy("host", "path").agg(F.min("verdict").alias("verdict")))
    shapes = [(r[0], r[1]) for r in rules.select(F.size(F.split("host", r"\.", -1)), F.length("path")).distinct().collect()]
    host, path = host_and_path(quoted(url))
    kept = without(pages.withColumn("__url_host", host).withColumn("__url_path", path), OUTPUT)

    # The verdict depends on host and path alone: each distinct pair is judged once.
    pairs = kept.select(F.col("__url_host").alias("__h"), F.col("__url_path").alias("__p")).distinct()
    labels = F.split("__h", r"\.", -1)
    shape = lambda n, m: F.when(
        (F.size(labels) >= n) & (F.length("__p") >= m),
        F.struct(F.substring_index("__h", ".", -n).alias("host"), F.substring("__p", 1, m).alias("path")))
    if not shapes:
        decided = pairs.select("__h", "__p", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")).limit(0)
    else:
        maybe = _probe(spark, bloom.build(rules.select(_key(F.col("host"), F.col("path")).alias("k"))))
        candidates = (pairs
                      .select("__h", "__p", F.explode(F.filter(F.array(*[shape(n, m) for n, m in sorted(shapes)]), lambda c: c.isNotNull())).alias("c"))
                      .select("__h", "__p", "c.host", "c.path")
                      .withColumn("k", _key(F.col("host"), F.col("path"))))
        hits = candidates.where(maybe(F.col("k"), bloom.bits_of(F.col("k")))).join(rules, ["host", "path"])
        rank = F.struct(F.length(F.concat("host", "path")), F.length("host"), F.concat("host", "path"), F.col("verdict"))
        decided = hits.groupBy("__h", "__p").agg(F.max(rank).alias("r")).select("__h", "__p", F.col("r.col3").alias("rule"), F.col("r.verdict").alias("verdict"))
    out = kept.join(decided, (F.col("__url_host") == F.col("__h")) & (F.col("__url_path") == F.col("__p")), "left")
    plain = [quoted(c) for c in kept.columns if c not in ("__url_host", "__url_path")]
    return out.select(*plain, F.col("__url_host").alias("host"), F.col("__url_path").alias("path"), "rule",
                      F.coalesce("verdict", F.lit(default)).alias("verdict"))
