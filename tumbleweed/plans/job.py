"""The batch feature job: records -> events -> fan-out -> route -> panes -> features.

Plan shape: scan -> parse (codegen) -> explode dims -> route join -> pane
HashAggregate over all cadences (partial / exchange / final) -> pane table;
per cadence: exchange on (id, id_type, feature) -> window frames -> window join.
Atom features need no shuffle at all.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tumbleweed.operators.atoms import atom_features
from tumbleweed.operators.fanout import fan_out
from tumbleweed.operators.panes import ITEM_KINDS, NUMERIC_KINDS, PANE_COLUMNS, PANE_SCHEMA, build_panes, pane_partials, panes_from_partials
from tumbleweed.operators.rollup import rollup_all
from tumbleweed.operators.route import route_windowed
from tumbleweed.plans.compile import CompiledSpecs, compile_specs
from tumbleweed.session import compiled_code_only, scratch_path, shuffles_dropped, sorted_collections
from tumbleweed.sources.events import parse_events

MINUTE_MS = 60_000


@dataclass
class FeatureJob:
    specs: DataFrame
    pane_ms: int = MINUTE_MS
    tz: str | None = None
    topic_dims: dict | None = None
    materialize: bool = True
    pane_path: str | None = None     # durable pane table location; default: a fresh folder under spark.checkpoint.dir
    compiled: CompiledSpecs = field(init=False)

    def __post_init__(self):
        self.compiled = compile_specs(self.specs)

    # -- stages ----------------------------------------------------------------
    def events(self, records: DataFrame) -> DataFrame:
        return parse_events(records)

    def fanned(self, records: DataFrame) -> DataFrame:
        """The events, once for each id type of their topic that some spec is routed by."""
        return fan_out(self.events(records), self.topic_dims, id_types=self.compiled.id_types())

    def routed(self, records: DataFrame) -> DataFrame:
        return route_windowed(self.fanned(records), self.compiled, self.pane_ms)

    def panes(self, records: DataFrame, *cadences: int) -> DataFrame:
        """The pane table of these cadences (default: the job's own), not written anywhere."""
        cs, cadences = self.compiled, cadences or (self.pane_ms,)
        routed = route_windowed(self.fanned(records), cs, *cadences)
        return build_panes(routed, cs.max_capacity(), cs.kinds_at(*cadences))

    def materialized_panes(self, records: DataFrame, *cadences: int) -> DataFrame:
        """Write the pane table and read it back.

        The partials feed two branches (numeric rows, and the item kinds'
        top-K); where there are both they are persisted for the duration of the write
        so the parse, fan-out and route run once, for all cadences.  The shuffle files of the write
        go when it ends; those of persisted partials stay until the driver lets them go.  The written pane
        table is what every roll-up reads: lineage is cut there (a lost
        executor re-reads a table, never re-parses events).

        With ``pane_path`` the table is durable and holds earlier runs' dates
        too: a run replaces the dates its records fall on, so it must be given
        all records of those dates.
        """
        from pyspark import StorageLevel

        spark = records.sparkSession
        cs, cadences = self.compiled, cadences or (self.pane_ms,)
        path = self.pane_path or scratch_path(spark, "panes")
        kinds = cs.kinds_at(*cadences)
        partials = pane_partials(route_windowed(self.fanned(records), cs, *cadences), kinds)
        shared = not (kinds <= set(NUMERIC_KINDS) or kinds <= set(ITEM_KINDS))
        if shared:
            partials = partials.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            panes = panes_from_partials(partials, cs.max_capacity(), kinds)
            if self.pane_path:
                panes = panes.withColumn("pane_date", F.to_date(F.timestamp_millis(F.col("pane_end_ms") - 1)))
            # a run's own table is read as a whole: a folder for each date would only make small files
            with compiled_code_only(spark), sorted_collections(spark), shuffles_dropped(spark):
                (panes.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("cadence_ms", "kind", *(["pane_date"] if self.pane_path else [])).parquet(path))
        finally:
            if shared:
                partials.unpersist()
        panes = spark.read.schema(PANE_SCHEMA + (", pane_date date" if self.pane_path else "")).parquet(path)
        return panes.where(F.col("cadence_ms").isin(*cadences)).select(*PANE_COLUMNS)

    def windowed_features(self, records: DataFrame | None = None, panes: DataFrame | None = None,
                          windows=None) -> DataFrame:
        """Windowed features of the job's cadence; ``windows`` (names) limits which look-backs are computed."""
        if panes is None:
            panes = self.materialized_panes(records) if self.materialize else self.panes(records)
        cs = self.compiled if windows is None else self.compiled.restrict_windows(windows)
        return rollup_all(panes, cs, self.pane_ms, self.tz)

    def atom_features(self, records: DataFrame) -> DataFrame:
        return atom_features(self.fanned(records), self.compiled)

    def features(self, records: DataFrame) -> DataFrame:
        """All features on one schema: windowed ones of every cadence, and atoms.

        The pane tables of all cadences come from one pass over the records;
        atoms, which need no shuffle, are a second, narrower one, taken when
        the result is read.
        """
        cadences = self.compiled.cadences()
        parts = []
        if cadences:
            panes = self.materialized_panes(records, *cadences) if self.materialize else self.panes(records, *cadences)
            parts = [rollup_all(panes, self.compiled, c, self.tz) for c in cadences]
        if self.compiled.rows["atom_fields"] or not parts:
            parts.append(self.atom_features(records))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out
