"""Files and folders through Hadoop's file system API: any storage that Spark reads and writes."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it doesn't exist."""
    fs, where = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that a reader sees all of it or nothing: under another name first, then renamed."""
    fs, where = _at(spark, path)
    _, draft = _at(spark, f"{path}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    if fs.exists(where):
        fs.delete(where, False)
    if not fs.rename(draft, where):
        raise OSError(f"cannot rename {path}.draft")


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def file_count(spark: SparkSession, folder: str) -> int:
    """Data files below a folder."""
    fs, where = _at(spark, folder)
    if not fs.exists(where):
        return 0
    files, n = fs.listFiles(where, True), 0
    while files.hasNext():
        name = files.next().getPath().getName()
        n += not name.startswith(("_", "."))
    return n
