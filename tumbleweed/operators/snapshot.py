"""Incremental latest-cell snapshot: a bucketed base, merged with deltas (O1-O3).

The base holds the newest version of every cell, bucketed by the cell's key.  A
delta is reduced to its newest cells, which shuffles the delta alone, into the
base's buckets; the merge reads the base bucket by bucket, without an exchange or a
sort of it, and writes the next base the same way (one file a bucket).

A *version* is one small file naming a base folder, its number of buckets and the
delta it ends with.  A delta that is applied again changes nothing, so a
replayed batch is safe; readers of one version never see another being written.
A delta's share of one bucket is hashed in memory: give a backfill as the first
delta, which is not joined at all, and later ones smaller than the base.
The bucket count doubles when buckets outgrow ``ROWS_A_BUCKET``, which shuffles the
base once each time it has doubled.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tumbleweed.operators.sinks import cell_snapshot
from tumbleweed.sources import folders

CELL = ["table", "row_key", "column"]
SNAPSHOT_SCHEMA = "table string, row_key string, column string, ts bigint, value string, ttl_ms bigint, expires_at_ms bigint"
ROWS_A_BUCKET = 2_000_000
#: Older versions kept for readers that still use them.
KEEP = 2


@dataclass(frozen=True)
class SnapshotVersion:
    number: int = -1
    folder: str = ""
    buckets: int = 0
    rows: int = 0


def _table(folder: str) -> str:
    return f"cells_{folder.replace('-', '_')}"


class CellSnapshot:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 8, rows_a_bucket: int = ROWS_A_BUCKET):
        self.spark, self.root, self.buckets, self.rows_a_bucket = spark, root, buckets, rows_a_bucket

    # -- versions ------------------------------------------------------------------
    def _versions(self) -> list[str]:
        return [n for n in folders.names(self.spark, f"{self.root}/versions") if n.endswith(".json")]

    def latest(self) -> SnapshotVersion:
        found = self._versions()
        return SnapshotVersion(**json.loads(folders.read_text(self.spark, f"{self.root}/versions/{found[-1]}"))) if found else SnapshotVersion()

    def _commit(self, version: SnapshotVersion) -> None:
        folders.write_text(self.spark, f"{self.root}/versions/{version.number:012d}.json", json.dumps(asdict(version)))
        names = self._versions()
        for name in names[:-KEEP]:
            old = SnapshotVersion(**json.loads(folders.read_text(self.spark, f"{self.root}/versions/{name}")))
            folders.delete(self.spark, f"{self.root}/versions/{name}")
            self.spark.sql(f"DROP TABLE IF EXISTS {_table(old.folder)}")
            folders.delete(self.spark, f"{self.root}/{old.folder}")

    # -- reading -------------------------------------------------------------------
    def _base(self, version: SnapshotVersion) -> DataFrame:
        """The base as a bucketed table of this session's catalog."""
        if not version.folder:
            return self.spark.createDataFrame([], SNAPSHOT_SCHEMA)
        name = _table(version.folder)
        columns = ", ".join("`{}` {}".format(*c.split()) for c in SNAPSHOT_SCHEMA.split(", "))
        keys = ", ".join(f"`{c}`" for c in CELL)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys}) "
                       f"INTO {version.buckets} BUCKETS LOCATION '{self.root}/{version.folder}'")
        return self.spark.table(name)

    def read(self, as_of_ms: int | None = None) -> DataFrame:
        """The newest version of each cell; with ``as_of_ms`` only those that have not expired (O3)."""
        rows = self._base(self.latest())
        return rows if as_of_ms is None else rows.where(F.col("expires_at_ms").isNull() | (F.col("expires_at_ms") > F.lit(as_of_ms)))

    # -- merging -------------------------------------------------------------------
    def merged(self, cells: DataFrame, version: SnapshotVersion) -> DataFrame:
        """Base and delta, the newer of each cell; equal times: the greater value.  Only the delta is shuffled."""
        rest = ["ts", "value", "ttl_ms", "expires_at_ms"]
        delta = cell_snapshot(cells).select(*CELL, F.struct(*rest).alias("new"))
        if not version.folder:
            return delta.select(*CELL, "new.*")
        base = self._base(version).select(*CELL, F.struct(*rest).alias("old"))
        # the delta, the smaller side, is the one that is hashed; the base streams through
        both = base.join(delta.repartition(version.buckets, *CELL).hint("shuffle_hash"), CELL, "full_outer")
        order = lambda c: F.struct(F.col(c)["ts"], F.col(c)["value"])
        newer = F.when(F.col("old").isNull() | (order("new") > order("old")), F.col("new")).otherwise(F.col("old"))
        return both.withColumn("v", newer).select(*CELL, *[F.col("v")[c].alias(c) for c in rest])

    def apply(self, cells: DataFrame, number: int, expired_before_ms: int | None = None) -> SnapshotVersion:
        """Merge the serving cells of delta ``number``; a delta not beyond the latest one is already in.

        Cells that expired before ``expired_before_ms`` are dropped.
        """
        before = self.latest()
        if number <= before.number:
            return before
        rows = self.merged(cells, before)
        if expired_before_ms is not None:
            rows = rows.where(F.col("expires_at_ms").isNull() | (F.col("expires_at_ms") > F.lit(expired_before_ms)))
        buckets = before.buckets or self.buckets
        while before.rows > buckets * self.rows_a_bucket:
            buckets *= 2
        if buckets != before.buckets:  # the first base, or outgrown buckets
            rows = rows.repartition(buckets, *CELL)
        folder = f"base-{number}-{uuid.uuid4().hex[:8]}"
        name = _table(folder)
        rows.write.format("parquet").bucketBy(buckets, *CELL).option("path", f"{self.root}/{folder}").saveAsTable(name)
        after = SnapshotVersion(number, folder, buckets, self.spark.table(name).count())
        self._commit(after)
        return after
