"""Raw records ``(topic, key, value)`` from a message bus or from files.

The Kafka source yields binary key/value columns; the same three string
columns are produced from JSON-lines or parquet files, which is the tested
path (no Kafka connector ships with this PySpark).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_SCHEMA = "topic string, key string, value string"


def decode_records(df: DataFrame) -> DataFrame:
    """Bytes (or strings) -> ``(topic, key, value)`` strings; NULLs kept."""
    cols = set(df.columns)
    topic = F.col("topic").cast("string") if "topic" in cols else F.lit(None).cast("string")
    key = F.col("key").cast("string") if "key" in cols else F.lit(None).cast("string")
    return df.select(topic.alias("topic"), key.alias("key"), F.col("value").cast("string").alias("value"))


def read_records(spark: SparkSession, fmt: str, path: str | None = None, *,
                 streaming: bool = False, options: dict[str, str] | None = None) -> DataFrame:
    """Open a record source by format name (``kafka``, ``json``, ``parquet``...).

    For ``kafka`` the options carry ``kafka.bootstrap.servers`` / ``subscribe``;
    ``startingOffsets`` defaults to ``latest`` for a stream; a batch read takes
    everything there is (``earliest``; Spark refuses ``latest`` there).
    """
    opts = dict(options or {})
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "latest" if streaming else "earliest")
        return decode_records(reader.format("kafka").options(**opts).load())
    reader = reader.format(fmt).options(**opts)
    if fmt in ("json", "csv") or streaming:
        reader = reader.schema(RECORD_SCHEMA)
    df = reader.load(path) if path is not None else reader.load()
    return decode_records(df)
