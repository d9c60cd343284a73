"""Feature specs as data.

A spec is one JSON object; a spec set is a DataFrame with :data:`SPEC_SCHEMA`.
Specs can come from a JSON file/folder, a table, or a list of dicts.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPEC_SCHEMA = (
    "id int, configType string, bizType string, idType string, featureNamePrefix string, "
    "typeConfig array<struct<bizType:string,eventType:string,targetType:string>>, "
    "aggConfig struct<field:string,fieldType:string,groupByField:string,eventTimeField:string,"
    "capacity:int,needTs:boolean,fields:array<struct<sourceField:string,featureName:string>>>, "
    "windows array<struct<delay:string,window:string,windowType:string>>, "
    "sinks array<struct<type:string,fields:map<string,struct<table:string,ttl:bigint,rename:string>>>>, "
    "updateTime timestamp"
)


def specs_from_json(spark: SparkSession, specs: Iterable[dict | str]) -> DataFrame:
    """Spec dicts (or JSON strings) -> spec DataFrame, parsed by Spark."""
    texts = [s if isinstance(s, str) else json.dumps(s) for s in specs]
    raw = spark.createDataFrame([(t,) for t in texts], "spec string")
    return raw.select(F.from_json("spec", SPEC_SCHEMA).alias("s")).select("s.*")


def read_specs(spark: SparkSession, path: str, fmt: str = "json", multi_line: bool = False) -> DataFrame:
    """Specs from a file or folder: one JSON object a line (``multi_line``: one object or array a file), or a table with these columns."""
    reader = spark.read.format(fmt)
    if fmt == "json":
        reader = reader.schema(SPEC_SCHEMA).option("multiLine", str(multi_line).lower())
    return reader.load(path)
