"""Atom features: stateless per-event projections (P6, P10-P12, C).

For each routed event and each ``{sourceField, featureName}`` of the spec,
emit ``<prefix>_<featureName>`` = the raw value when it is not blank.  No
shuffle: a broadcast route join, then ``explode`` of the spec's field list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tumbleweed.functions.fields import field_value, lenient
from tumbleweed.functions.scalars import not_blank
from tumbleweed.operators.route import route_atoms
from tumbleweed.plans.compile import CompiledSpecs, literal_table, spec_broadcast


def atom_features(fanned: DataFrame, cs: CompiledSpecs) -> DataFrame:
    by_spec: dict[int, list] = {}
    for r in cs.rows["atom_fields"]:
        by_spec.setdefault(r.spec_id, []).append((r.source_field, r.out_name))
    fields = literal_table(
        fanned.sparkSession, [(sid, f) for sid, f in sorted(by_spec.items())],
        "spec_id int, fields array<struct<source_field:string,out_name:string>>")
    routed = route_atoms(fanned, cs).join(
        spec_broadcast(fields, len(cs.rows["atom_fields"])), "spec_id")
    one = routed.select("id", "id_type", "uid", "biz_type", "event_type", "target_type", "event_ms", "ext", "attrs",
                        F.explode("fields").alias("f"))
    with lenient(fanned.sparkSession):
        out = one.select(
            "id", "id_type", F.col("f.out_name").alias("feature_name"),
            F.col("event_ms").alias("ts"), field_value(F.col("f.source_field"), cs.expressions).alias("value_text"),
        )
    return out.where(not_blank(F.col("value_text"))).select(
        "id", "id_type", F.lit(None).cast("string").alias("feature"), "feature_name",
        F.lit(None).cast("string").alias("window"), "ts",
        F.lit(None).cast("bigint").alias("value_long"), F.lit(None).cast("double").alias("value_double"),
        "value_text", F.lit("string").alias("value_type"),
    )
