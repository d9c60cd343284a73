"""Structured Streaming feature job.

    readStream (kafka / json / parquet records)
      -> foreachBatch, for the specs of that moment:
           1. parse -> fan-out -> route -> base-cadence partials of the batch,
              appended to the pane table (one shuffle, combined map-side);
           2. the panes of every cadence that the watermark has passed: their
              partials, this batch's and earlier ones', combined;
           3. the history those panes look back on, roll-up, features, sinks;
           4. the new version of the pane table, which makes all of it count.
    readStream -> foreachBatch: atoms -> features, sinks                (stateless)

The *state* is the pane table: partials at the base cadence (the greatest length
that divides every cadence in use), merged into second, minute and hour panes
by one associative combine.  Routing happens inside the batch, so specs can be
added, changed and deleted while the query runs, and its state outlives any
checkpoint of operators.

The *watermark* is the newest event time so far less ``delay``, kept in the
table's version: a pane closes when it passes the pane's end.  An event whose base
pane was closed before its batch is *late*: it is counted exactly and written to
``late/``.  Within ``lateness`` it is merged all the same, and every closed
pane it belongs to, and every feature that looks back on one, is computed again and
written under the later batch: ``read_features`` gives each feature in its newest form.

Everything a batch writes lies under its ``batch_id`` and is replaced when the batch
is run again; a batch whose version is committed is not run again (T5).

:func:`pane_stream` is the same partial aggregation as a stateful operator of
Spark's, for one cadence, fixed specs and the built-in kinds (T1, T2).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tumbleweed.functions.intervals import duration_ms
from tumbleweed.functions.scalars import pane_end_ms
from tumbleweed.operators.fanout import fan_out
from tumbleweed.operators.panes import (NUMERIC_KINDS, PANE_COLUMNS, PANE_KEYS, PANE_SCHEMA, coarser_partials, combine_partials, pane_partials,
                                        pane_partials_streaming, panes_from_partials, retain_panes)
from tumbleweed.operators.rollup import FEATURE_COLUMNS, WANTED, rollup_all
from tumbleweed.operators.route import route_windowed
from tumbleweed.operators.sinks import write_sinks
from tumbleweed.plans.compile import spec_broadcast, unbroadcast
from tumbleweed.plans.job import FeatureJob
from tumbleweed.plans.kinds import added_kinds
from tumbleweed.session import compiled_code_only, scratch_path, sorted_collections
from tumbleweed.sources.records import read_records
from tumbleweed.streaming.pane_table import PaneTable, Version, newest_panes

#: A job, or what gives the job for a batch number.
JobSource = FeatureJob | Callable[[int], FeatureJob]
LONG_AGO = -(1 << 62)


def pane_stream(job: FeatureJob, records: DataFrame, delay: str = "1 minute") -> DataFrame:
    """Streaming pane partials of ``records`` (a streaming ``(topic, key, value)`` frame) by a stateful aggregation."""
    routed = job.routed(records)
    # withWatermark needs a TIMESTAMP (not NTZ) column
    routed = routed.withColumn("event_ts", F.timestamp_millis("event_ms")).withWatermark("event_ts", delay)
    return pane_partials_streaming(routed, job.pane_ms)


@dataclass
class StreamPaths:
    panes: str                   # the pane table's root
    features: str
    checkpoint: str
    sinks: str | None = None     # where sink writers put cells and messages; None: features only
    message_rows: int | None = None  # a message for so many rows of an entity, or a second; None: for each time


def job_of(source: JobSource, batch_id: int) -> FeatureJob:
    return source if isinstance(source, FeatureJob) else source(batch_id)


class FeatureBatchWriter:
    """``foreachBatch`` handler of the windowed half."""

    def __init__(self, job: JobSource, paths: StreamPaths, delay: str | int = 60_000, lateness: str | int = 0):
        self.source, self.paths = job, paths
        self.delay_ms, self.lateness_ms = duration_ms(delay), duration_ms(lateness)
        self.table: PaneTable | None = None

    def __call__(self, records: DataFrame, batch_id: int) -> None:
        if self.table is None:
            self.table = PaneTable(records.sparkSession, self.paths.panes)
        before = self.table.latest()
        if batch_id == before.number:
            return  # everything was written and committed; only the query's own log missed it
        if batch_id < before.number:
            raise ValueError(f"batch {batch_id} comes after version {before.number} of the pane table: it belongs to another checkpoint")
        job = job_of(self.source, batch_id)
        base = job.compiled.base_cadence()
        version = self._take_in(records, batch_id, before, job, base or 1_000)
        if base is not None:
            version = self._close_panes(batch_id, before, version, job)
            version = self._compact(version, job)
        self.table.commit(replace(version, number=batch_id))

    # -- 1. the batch's events -----------------------------------------------------
    def _take_in(self, records: DataFrame, batch_id: int, before: Version, job: FeatureJob, base: int) -> Version:
        """Append the batch's partials; count its events and move the watermark."""
        spark, table = records.sparkSession, self.table
        watermark = LONG_AGO if before.watermark is None else before.watermark
        end = pane_end_ms(F.col("event_ms"), base)
        counts = [F.max("event_ms").alias("newest"), F.count("event_ms").alias("n"), F.count(F.when(end <= F.lit(watermark), 1)).alias("late")]
        kinds = job.compiled.kinds_at(*job.compiled.cadences())
        events, seen = job.events(records), Observation()
        # a kind with a pane level of its own reads the events a second time: they would be observed twice
        observed = not added_kinds(kinds)
        routed = route_windowed(fan_out(events.observe(seen, *counts) if observed else events, job.topic_dims, id_types=job.compiled.id_types()), job.compiled,
                                *job.compiled.cadences(), as_cadence=base)
        partials = pane_partials(routed, kinds)
        folder = table.write("partials", partials.where(F.col("pane_end_ms") > F.lit(watermark - self.lateness_ms)),
                             f"partials/batch={batch_id}", batch_id)
        # an empty result may have been found without its input: then there is little to count
        counted = seen.get if folder and observed else events.agg(*counts).first().asDict()
        late = applied = 0
        if counted["late"]:  # rare: the late events themselves, counted from what was written
            path = f"{table.root}/late/batch_id={batch_id}"
            (job.events(records).withColumn("pane_end_ms", end).where(F.col("pane_end_ms") <= F.lit(watermark))
             .select("topic", "uid", "biz_type", "event_type", "target_type", "event_ms", "pane_end_ms",
                     (F.col("pane_end_ms") > F.lit(watermark - self.lateness_ms)).alias("applied"), "attrs")
             .write.mode("overwrite").parquet(path))
            late, applied = spark.read.parquet(path).agg(F.count(F.lit(1)), F.count(F.when(F.col("applied"), 1))).first()
        newest = counted["newest"]
        after = before.watermark if newest is None else max(watermark, newest - self.delay_ms)
        return replace(before, watermark=after, events=before.events + counted["n"], late=before.late + late, applied=before.applied + applied,
                       partials=before.partials + ((folder,) if folder else ()))

    # -- 2, 3. closed panes and their features ----------------------------------------
    def _close_panes(self, batch_id: int, before: Version, version: Version, job: FeatureJob) -> Version:
        spark, table, cs = self.table.spark, self.table, job.compiled
        old, new = (LONG_AGO if v.watermark is None else v.watermark for v in (before, version))
        late = version.applied > before.applied
        if new <= old and not late:
            return version
        rows, n_rows = cs.feature_cadences()
        cadences = spec_broadcast(rows, n_rows)
        kinds = cs.kinds_at(*cs.cadences())
        widest = max(cs.cadences())
        first = (old - (self.lateness_ms if late else 0)) // widest * widest
        placed = coarser_partials(table.read("partials", version.partials, first), cadences).where(F.col("pane_end_ms") <= F.lit(new))
        chosen = placed.where(F.col("pane_end_ms") > F.lit(old))
        pane = ["id", "id_type", "feature", "cadence_ms", "pane_end_ms"]
        if late:  # closed panes that this batch's late partials belong to: all their partials again
            touched = placed.where((F.col("batch_id") == batch_id) & (F.col("pane_end_ms") <= F.lit(old))).select(*pane).distinct()
            chosen = chosen.unionByName(placed.where(F.col("pane_end_ms") <= F.lit(old)).join(unbroadcast(touched), pane, "left_semi"))
            combined = combine_partials(chosen, kinds)
        else:
            combined = self._combined(version, before, chosen, first, old, new, job)
        panes = panes_from_partials(combined, cs.max_capacity(), kinds).select(*PANE_COLUMNS)
        with sorted_collections(spark):
            folder = table.write("panes", panes, f"panes/batch={batch_id}", batch_id, corrects=late)
        if folder is None:
            return version
        version = replace(version, panes=version.panes + (folder,))
        current = table.read("panes", [folder])
        # History is read for the batch's own entities and features only, from folders inside the horizon, and each
        # feature by its own retention: the cost follows the batch, not the whole table.
        # Its features are those at its own panes: the history says which they are, so none are joined afterwards.
        keys = ["id", "id_type", "feature", "cadence_ms"]
        horizon = self._horizon(job)
        history = table.read("panes", version.panes, folder.lo - horizon)
        kept = lambda rows, wanted: retain_panes(rows, cs, folder.lo, job.pane_ms).withColumn(WANTED, wanted)
        corrected = any(f.corrects for f in version.panes)
        own = None
        if late:  # panes after a corrected one look back on it
            old_end = F.when(F.col("pane_end_ms") <= F.lit(old), F.col("pane_end_ms"))
            redone = current.groupBy(*keys).agg(F.min(old_end).alias("lo"), F.max(old_end).alias("hi"))
            history = history.join(unbroadcast(redone), keys)
            after = (F.col("pane_end_ms") > F.col("lo")) & (F.col("pane_end_ms") < F.col("hi") + F.lit(horizon))
            history = kept(history, (F.col("batch_id") == F.lit(batch_id)) | F.coalesce(after, F.lit(False)))
        else:  # the batch's own panes are all wanted, and none of them is an earlier one's: only earlier ones are chosen by a join
            earlier = history.where(F.col("batch_id") != F.lit(batch_id)).join(unbroadcast(current.select(*keys).distinct()), keys, "left_semi")
            history, own = kept(earlier, F.lit(False)), kept(current, F.lit(True)).select(*PANE_COLUMNS, WANTED)
        if corrected:  # flags go by key and time, which all forms of a pane share, or by its newest form
            history = newest_panes(history, WANTED)
        history = history.select(*PANE_COLUMNS, WANTED)
        # numbers are rolled up in one pass; where there are other kinds too, the joined history is kept for them
        shared = len(kinds) > 1 and not kinds <= set(NUMERIC_KINDS)
        history = history.persist(StorageLevel.MEMORY_AND_DISK) if shared else history
        seen = history if own is None else own.unionByName(history)
        features = None
        for cadence in cs.cadences():
            part = rollup_all(seen, cs, cadence, job.tz)
            features = part if features is None else features.unionByName(part)
        try:
            write_features(features.select(*FEATURE_COLUMNS), job, self.paths, f"source=windowed/batch_id={batch_id}")
        finally:
            if shared:
                history.unpersist()
        return version

    def _combined(self, version: Version, before: Version, chosen: DataFrame, first: int, old: int, new: int, job: FeatureJob) -> DataFrame:
        """The partials of the panes that close, combined: base-cadence panes with partials of this batch only are so already."""
        cs, table = job.compiled, self.table
        kinds, base = cs.kinds_at(*cs.cadences()), cs.base_cadence()
        mine = [f for f in version.partials if f not in before.partials]
        if not mine or added_kinds(kinds):
            return combine_partials(chosen, kinds)
        rows, n_rows = cs.feature_cadences()
        cadences = spec_broadcast(rows, n_rows)
        # earlier partials may be of another base cadence: the last of these panes they can reach
        shared_to = max((-(-f.hi // base) * base for f in before.partials), default=LONG_AGO)
        lone = coarser_partials(table.read("partials", mine, max(shared_to, first)), cadences).where(
            (F.col("cadence_ms") == F.lit(base)) & (F.col("pane_end_ms") > F.lit(old)) & (F.col("pane_end_ms") <= F.lit(new))).drop("batch_id")
        if set(cs.cadences()) != {base}:
            rest = chosen.where((F.col("cadence_ms") != F.lit(base)) | (F.col("pane_end_ms") <= F.lit(shared_to)))
        elif shared_to > old:
            rest = coarser_partials(table.read("partials", version.partials, first).where(F.col("pane_end_ms") <= F.lit(shared_to)), cadences).where(
                (F.col("pane_end_ms") > F.lit(old)) & (F.col("pane_end_ms") <= F.lit(new)))
        else:
            return lone
        return combine_partials(rest, kinds).unionByName(lone)

    def _horizon(self, job: FeatureJob) -> int:
        """The longest retention of any feature (see ``retention_ms``)."""
        whole = {"today": 24 * 3_600_000, "yesterday": 48 * 3_600_000}
        return max([3_600_000, *[w.window_ms or whole.get(w.whole, 0) for w in job.compiled.rows["windows"]]])

    # -- 4. retention ---------------------------------------------------------------
    def _compact(self, version: Version, job: FeatureJob) -> Version:
        """Drop what no open pane, no late event and no look-back needs any more; merge small folders."""
        if version.watermark is None:
            return version
        cs = job.compiled
        widest = max(cs.cadences())
        spent = (version.watermark - self.lateness_ms) // widest * widest
        as_of = version.watermark - self.lateness_ms
        keep = {"partials": lambda rows: rows.where(F.col("pane_end_ms") > F.lit(spent)),
                "panes": lambda rows: retain_panes(rows, cs, as_of, job.pane_ms).select(*PANE_COLUMNS, "batch_id")}
        return self.table.compacted(version, {"partials": spent, "panes": as_of - self._horizon(job)}, keep)


class AtomBatchWriter:
    """``foreachBatch`` handler of the stateless half: atom features of a batch's records."""

    def __init__(self, job: JobSource, paths: StreamPaths):
        self.source, self.paths = job, paths

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        job = job_of(self.source, batch_id)
        write_features(job.atom_features(batch).select(*FEATURE_COLUMNS), job, self.paths, f"source=atom/batch_id={batch_id}")


def write_features(features: DataFrame, job: FeatureJob, paths: StreamPaths, part: str) -> None:
    """Write a batch's features, then what the sinks take of them; a replayed batch replaces its own output."""
    path = f"{paths.features}/{part}"
    with sorted_collections(features.sparkSession):
        features.write.mode("overwrite").parquet(path)
    if paths.sinks:
        write_sinks(features.sparkSession.read.schema(features.schema).parquet(path), job.compiled, paths.sinks, part, paths.message_rows)


class FeatureStream:
    """The queries of one job: windowed features, and atoms if a spec asks for them."""

    def __init__(self, queries: list, paths: StreamPaths | None = None):
        self.queries, self.paths = queries, paths

    def awaitTermination(self, timeout: float | None = None):
        return all([q.awaitTermination(timeout) if timeout else q.awaitTermination() or True for q in self.queries])

    def processAllAvailable(self) -> None:
        for q in self.queries:
            q.processAllAvailable()

    def stop(self) -> None:
        for q in self.queries:
            q.stop()

    @property
    def isActive(self) -> bool:
        return any(q.isActive for q in self.queries)

    def exception(self):
        return next((e for q in self.queries if (e := q.exception()) is not None), None)

    def late_events(self, spark: SparkSession) -> tuple[int, int]:
        """Events that came after their pane was closed, since the beginning, and how many of them were still merged."""
        version = PaneTable(spark, self.paths.panes).latest()
        return version.late, version.applied


def start_feature_stream(job: JobSource, records: DataFrame, paths: StreamPaths, *, delay: str | int = "1 minute",
                         lateness: str | int = 0, trigger: dict | None = None, atoms: bool | None = None) -> FeatureStream:
    """Start the streaming job (windowed features of every cadence, atoms, sinks).

    ``job`` may be a function of the batch number (see :class:`SpecSource`): each
    batch then runs with the specs of that moment.  ``atoms`` starts the stateless half;
    by default where the first job has atom specs, or the job can change.
    """
    trigger = trigger or {"processingTime": "1 second"}
    if atoms is None:
        atoms = not isinstance(job, FeatureJob) or bool(job.compiled.rows["atom_fields"])
    queries = []
    with compiled_code_only(records.sparkSession):  # a stream keeps the settings it was started with
        if not isinstance(job, FeatureJob) or job.compiled.cadences():
            queries.append(records.writeStream.option("checkpointLocation", paths.checkpoint)
                           .foreachBatch(FeatureBatchWriter(job, paths, delay, lateness)).trigger(**trigger).start())
        if atoms:
            queries.append(records.writeStream.option("checkpointLocation", f"{paths.checkpoint}-atoms")
                           .foreachBatch(AtomBatchWriter(job, paths)).trigger(**trigger).start())
    return FeatureStream(queries, paths)


def read_panes(spark: SparkSession, paths: StreamPaths) -> DataFrame:
    """The closed panes of the newest version, each in its newest form."""
    table = PaneTable(spark, paths.panes)
    return table.panes(table.latest().panes)


def read_features(spark: SparkSession, paths: StreamPaths) -> DataFrame:
    """Features, each in its newest form: a batch that corrects one has a higher ``batch_id``."""
    features = spark.read.parquet(paths.features)
    if not PaneTable(spark, paths.panes).latest().applied:
        return features
    # a batch writes a feature once; times first, since they alone decide most comparisons of the sort
    newest = F.max("batch_id").over(Window.partitionBy("ts", "id", "id_type", "feature", "feature_name"))
    windowed = features.where(F.col("source") == "windowed").withColumn("_newest", newest).where(F.col("batch_id") == F.col("_newest"))
    return windowed.select(*features.columns).unionByName(features.where(F.col("source") != "windowed"))


def read_outputs(spark: SparkSession, paths: StreamPaths) -> tuple[DataFrame, DataFrame]:
    return read_panes(spark, paths), read_features(spark, paths)


# --------------------------------------------------------------------------- catch-up runner
ROWS_PER_FILE = 500_000


def write_record_files(spark: SparkSession, records: DataFrame, folder: str, chunks: int = 4, late=None) -> int:
    """Lay records out as JSON files in event-time order; returns the number of files of a chunk, which follows its rows.

    The file source picks files up by modification time; appending the time
    ranges one after another, and reading a chunk's files together, reproduces
    an in-order feed across micro-batches.  Where the condition ``late`` holds (on the
    record's JSON), a record comes one chunk after its time.  Records are made and staged
    once with their times, which the slices are cut by; then each slice is copied.
    """
    clock = F.get_json_object("value", "$.ext.eventTime").cast("bigint")
    behind = F.lit(0) if late is None else F.when(late, 1).otherwise(0)
    stage = f"{folder}-staging"
    records.withColumn("_ms", clock).withColumn("_behind", behind).write.parquet(stage)
    staged = spark.read.parquet(stage)
    bounds = staged.agg(F.min("_ms").alias("lo"), F.max("_ms").alias("hi")).first()
    width = max(1, (bounds.hi - bounds.lo) // chunks + 1)
    staged = staged.withColumn("_slice", F.least(((F.col("_ms") - F.lit(bounds.lo)) / F.lit(width)).cast("int") + F.col("_behind"), F.lit(chunks - 1)))
    most = staged.groupBy("_slice").count().agg(F.max("count")).first()[0] or 1
    files = -(-most // ROWS_PER_FILE)
    for i in range(chunks):
        part = staged.where(F.col("_slice") == i).drop("_ms", "_behind", "_slice")
        part.repartition(files).write.mode("append").json(folder)
    return files


def catch_up_from_table(spark: SparkSession, sf_dir: str, job: JobSource, delay: str = "1 minute", lateness: str | int = 0, late=None,
                        chunks: int = 4, message_rows: int | None = None) -> StreamPaths:
    """Catch up a file stream of the ``events`` table with ``availableNow``; returns where the outputs are."""
    from tumbleweed.sources.standin import event_records

    root = scratch_path(spark, "stream")
    source = f"{root}/source"
    files = write_record_files(spark, event_records(spark, sf_dir), source, chunks, late)
    paths = StreamPaths(panes=f"{root}/panes", features=f"{root}/features", checkpoint=f"{root}/checkpoint", sinks=f"{root}/sinks",
                        message_rows=message_rows)
    records = read_records(spark, "json", source, streaming=True, options={"maxFilesPerTrigger": str(files)})
    start_feature_stream(job, records, paths, delay=delay, lateness=lateness, trigger={"availableNow": True}).awaitTermination()
    return paths


def run_pane_stream_from_table(spark: SparkSession, sf_dir: str, job: JobSource, delay: str = "1 minute", **options) -> tuple[DataFrame, DataFrame]:
    """Panes and features of :func:`catch_up_from_table`."""
    return read_outputs(spark, catch_up_from_table(spark, sf_dir, job, delay, **options))


def stateful_panes_from_table(spark: SparkSession, sf_dir: str, job: FeatureJob, delay: str = "1 minute") -> DataFrame:
    """Pane partials of the ``events`` table by :func:`pane_stream`, through a parquet sink."""
    from tumbleweed.sources.standin import event_records

    root = scratch_path(spark, "stateful")
    files = write_record_files(spark, event_records(spark, sf_dir), f"{root}/source")
    records = read_records(spark, "json", f"{root}/source", streaming=True, options={"maxFilesPerTrigger": str(files)})
    # The state store keeps spark.sql.shuffle.partitions partitions for the life of a checkpoint: size this run's to the cores.
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    spark.conf.set(key, str(max(1, spark.sparkContext.defaultParallelism)))
    try:
        partials = pane_stream(job, records, delay)
        (partials.writeStream.format("parquet").outputMode("append").option("path", f"{root}/partials")
         .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    finally:
        spark.conf.set(key, previous)
    done = spark.read.schema(partials.schema).parquet(f"{root}/partials")
    return panes_from_partials(done, job.compiled.max_capacity(), job.compiled.kinds_at(job.pane_ms))


# --------------------------------------------------------------------------- changing specs
def spec_version(specs: DataFrame) -> str:
    """The change marker of a spec set (S6): it differs when any spec is added, changed or deleted."""
    row = specs.agg(F.count(F.lit(1)).alias("n"), F.max("updateTime").alias("t"),
                    F.bit_xor(F.xxhash64(F.to_json(F.struct("*")))).alias("x")).first()
    return f"{row.n}/{row.t}/{row.x}"


class SpecSource:
    """The job for each micro-batch, compiled anew when the spec table has changed.

    Routing happens inside the batch, so the running query goes on: a new spec counts
    from the batch that first sees it, a deleted one gives no more features, and
    partials of open panes are kept whatever changes.  The spec table is read
    no more often than every ``every_s`` seconds.
    """

    def __init__(self, load_specs: Callable[[], DataFrame], make_job: Callable[[DataFrame], FeatureJob] = FeatureJob, every_s: float = 10.0):
        self.load_specs, self.make_job, self.every_s = load_specs, make_job, every_s
        self.version: str | None = None
        self.job: FeatureJob | None = None
        self.compiled = 0
        self._read_at = float("-inf")

    def __call__(self, batch_id: int) -> FeatureJob:
        import time

        if time.monotonic() - self._read_at >= self.every_s:
            specs = self.load_specs()
            version = spec_version(specs)
            self._read_at = time.monotonic()
            if version != self.version:
                self.job, self.version = self.make_job(specs), version
                self.compiled += 1
        return self.job


__all__ = ["pane_stream", "start_feature_stream", "StreamPaths", "FeatureBatchWriter", "AtomBatchWriter", "read_outputs", "read_panes",
           "read_features", "run_pane_stream_from_table", "stateful_panes_from_table", "spec_version", "SpecSource", "PANE_KEYS", "PANE_SCHEMA"]
