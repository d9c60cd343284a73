"""The stream's pane table: versions of a list of folders, swapped by one small file.

A batch writes its own folders and then its *version*: a JSON file that lists
every folder of the table.  Readers take one version and read the folders it
names, so they never see half a batch, a folder that is being compacted, or one
that a replayed batch is writing again; nothing lists the table's folders.

Two lists: ``partials`` are base-cadence partials (what late events are merged
into and coarser panes are made of), ``panes`` the closed panes of every cadence.
Each folder is known with its span of pane ends, so a read takes the folders of its
span.  ``FAN_IN`` folders of one level are merged into one of the next, without
the rows that are past their retention; folders past it altogether are dropped.
So the number of folders grows with the logarithm of the retained batches.
Replaced folders are deleted ``KEEP`` versions later, when no reader of an older
version should be left.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tumbleweed.operators.panes import PANE_COLUMNS, PANE_KEYS, PANE_SCHEMA, PARTIAL_SCHEMA
from tumbleweed.sources import folders

FAN_IN = 8
KEEP = 3
SCHEMAS = {"partials": PARTIAL_SCHEMA + ", batch_id bigint", "panes": PANE_SCHEMA + ", batch_id bigint"}


@dataclass(frozen=True)
class Folder:
    path: str              # below the table's root
    lo: int                # first and last pane end
    hi: int
    rows: int
    level: int = 0
    corrects: bool = False  # holds panes that replace those of earlier batches


@dataclass(frozen=True)
class Version:
    number: int = -1
    watermark: int | None = None
    specs: str = ""
    events: int = 0
    late: int = 0          # events that came after their pane was closed
    applied: int = 0       # of these, the ones that were merged into it
    partials: tuple[Folder, ...] = ()
    panes: tuple[Folder, ...] = ()
    garbage: tuple[tuple[str, int], ...] = field(default=())   # replaced folders and the version that replaced them

    def text(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def read(cls, text: str) -> Version:
        raw = json.loads(text)
        raw |= {k: tuple(Folder(**f) for f in raw[k]) for k in ("partials", "panes")}
        return cls(**raw | {"garbage": tuple((p, n) for p, n in raw["garbage"])})


class PaneTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._latest: Version | None = None

    # -- versions ------------------------------------------------------------------
    def latest(self) -> Version:
        """The newest committed version (number -1 before the first)."""
        if self._latest is None:
            found = [n for n in folders.names(self.spark, f"{self.root}/versions") if n.endswith(".json")]
            self._latest = Version.read(folders.read_text(self.spark, f"{self.root}/versions/{found[-1]}")) if found else Version()
        return self._latest

    def commit(self, version: Version) -> None:
        old = [g for g in version.garbage if g[1] <= version.number - KEEP]
        version = replace(version, garbage=tuple(g for g in version.garbage if g not in old))
        folders.write_text(self.spark, f"{self.root}/versions/{version.number:012d}.json", version.text())
        self._latest = version
        # only now may anything go that an older version names
        for path, _ in old:
            folders.delete(self.spark, f"{self.root}/{path}")
        for name in folders.names(self.spark, f"{self.root}/versions")[:-KEEP]:
            folders.delete(self.spark, f"{self.root}/versions/{name}")

    # -- folders -------------------------------------------------------------------
    def write(self, name: str, rows: DataFrame, path: str, batch_id: int | None = None, corrects: bool = False, level: int = 0) -> Folder | None:
        """Write rows under ``path``, replacing what a failed attempt left; None if there are none."""
        if batch_id is not None:
            rows = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        rows.write.mode("overwrite").parquet(f"{self.root}/{path}")
        span = (self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.root}/{path}")
                .agg(F.min("pane_end_ms").alias("lo"), F.max("pane_end_ms").alias("hi"), F.count(F.lit(1)).alias("n")).first())
        return Folder(path, span.lo, span.hi, span.n, level, corrects) if span.n else None

    def read(self, name: str, entries, after: int | None = None) -> DataFrame:
        """Rows of these folders with a pane end after ``after``."""
        found = [f for f in entries if after is None or f.hi > after]
        if not found:
            return self.spark.createDataFrame([], SCHEMAS[name])
        rows = self.spark.read.schema(SCHEMAS[name]).parquet(*[f"{self.root}/{f.path}" for f in found])
        return rows if after is None else rows.where(F.col("pane_end_ms") > F.lit(after))

    def panes(self, entries, after: int | None = None) -> DataFrame:
        """Panes, each in its newest form."""
        rows = self.read("panes", entries, after)
        return newest_panes(rows) if any(f.corrects for f in entries) else rows

    # -- retention and compaction -----------------------------------------------------
    def compacted(self, version: Version, expired: dict[str, int], keep: dict[str, Callable[[DataFrame], DataFrame]]) -> Version:
        """``version`` without expired folders and with full levels merged; ``keep`` filters the rows that are still needed."""
        lists: dict[str, tuple[Folder, ...]] = {}
        garbage = list(version.garbage)
        for name in ("partials", "panes"):
            live = [f for f in getattr(version, name) if f.hi > expired[name]]
            garbage += [(f.path, version.number) for f in getattr(version, name) if f not in live]
            level = 0
            while level <= max((f.level for f in live), default=-1):
                full = [f for f in live if f.level == level]
                if len(full) >= FAN_IN:
                    rows = self.read(name, full)
                    if name == "panes" and any(f.corrects for f in full):
                        rows = newest_panes(rows)
                    # a merged folder still replaces older ones if one of its parts did
                    merged = self.write(name, keep[name](rows), f"{name}/merged={version.number}-{level + 1}", corrects=any(f.corrects for f in full), level=level + 1)
                    live = [f for f in live if f not in full] + ([merged] if merged else [])
                    garbage += [(f.path, version.number) for f in full]
                level += 1
            lists[name] = tuple(live)
        return replace(version, **lists, garbage=tuple(garbage))


def newest_panes(rows: DataFrame, *more: str) -> DataFrame:
    """One row per pane key: that of the newest batch.

    A batch writes a pane once, so its newest rows are one; a window sorts once, after the
    shuffle (or needs none where rows come dealt by a part of the key), and an aggregate of texts twice.
    """
    newest = F.max("batch_id").over(Window.partitionBy("pane_end_ms", *[k for k in PANE_KEYS if k != "pane_end_ms"]))
    return rows.withColumn("_newest", newest).where(F.col("batch_id") == F.col("_newest")).select(*PANE_COLUMNS, "batch_id", *more)
