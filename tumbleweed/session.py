"""Session helpers.

On a cluster the session is created by the launcher; the library only reads
settings from it.  ``local_session`` exists for tests and local runs.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tumbleweed") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TW_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
#: HotSpot leaves methods beyond so many bytes of code to its interpreter.
HOTSPOT_LIMIT = 8000


@contextmanager
def compiled_code_only(spark: SparkSession):
    """While jobs run and streams are started: whole-stage code too long for HotSpot's compiler gives way to operators compiled one by one.

    The pane aggregate of many kinds is such code; interpreted, it takes twice the time.
    A smaller limit that the session sets itself is kept.
    """
    before = spark.conf.get(METHOD_LIMIT, "65535")
    spark.conf.set(METHOD_LIMIT, str(min(int(before), HOTSPOT_LIMIT)))
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """While jobs write a table: their shuffle files go when the write ends, not when the driver's memory is next collected.

    What is written is read back from its folder, so nothing reads them again; kept, they
    lie on disk beside those of all later steps.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def sorted_collections(spark: SparkSession):
    """While jobs run: lists are collected from sorted rows.

    Hashed in memory, they give way to a sort after 128 groups, once on each side of the exchange;
    a sort that is there already serves both.
    """
    key = "spark.sql.execution.useObjectHashAggregateExec"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster launcher sets it to shared storage; only when it is unset (tests,
    local runs) do we pick a scratch folder of our own.
    """
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediates and checkpoints.

    ``spark.checkpoint.dir`` names it on a cluster.  Only a local session may
    go without: it gets a folder of its own.  A cluster session without the
    setting is refused, because a machine-local folder would lose rows there.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if conf:
        if current is None:
            spark.sparkContext.setCheckpointDir(conf)
        return conf.rstrip("/")
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tumbleweed-ckpt-", dir="/tmp"))
        current = spark.sparkContext.getCheckpointDir()
    # the context keeps its checkpoints in a sub-folder of the one it was given
    return current.rstrip("/").rsplit("/", 1)[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    import uuid

    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
