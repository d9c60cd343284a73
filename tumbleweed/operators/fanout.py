"""Dimension fan-out and entity ids.

Each event is emitted once per id type of its topic -- one scan with
``explode``, not one branch per dimension unioned together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tumbleweed.functions.scalars import not_blank

# Id types per topic (the liveroom topic adds the anchor).
DEFAULT_DIMS = ("uid", "targetUid")
TOPIC_DIMS = {
    "DYNAMIC": ("uid", "targetUid"),
    "LIVEROOM": ("uid", "targetUid", "anchorUid"),
    "ORDER": ("uid", "targetUid"),
    "GAME": ("uid", "targetUid"),
    "USER": ("uid", "targetUid"),
}


def _dims_array(topic_dims: dict[str, tuple[str, ...]], default: tuple[str, ...], id_types=None):
    arr = lambda dims: F.array(*[F.lit(d) for d in dims if id_types is None or d in id_types]).cast("array<string>")
    expr = None
    for topic, dims in sorted(topic_dims.items()):
        cond = F.col("topic") == topic
        expr = F.when(cond, arr(dims)) if expr is None else expr.when(cond, arr(dims))
    return arr(default) if expr is None else expr.otherwise(arr(default))


def fan_out(events: DataFrame, topic_dims: dict[str, tuple[str, ...]] | None = None,
            default_dims: tuple[str, ...] = DEFAULT_DIMS, id_types=None) -> DataFrame:
    """One row per (event, id type); ``id`` from ``uid`` or ``ext[id_type]``.

    Rows whose id is blank are dropped (P3); an event without ``ext`` yields
    no id for the secondary id types (P2).  ``id_types`` limits the rows to these id types
    (those of the routes: rows of others would be made only to be dropped by their join).
    """
    dims = _dims_array(TOPIC_DIMS if topic_dims is None else topic_dims, default_dims, id_types)
    exploded = events.withColumn("id_type", F.explode(dims))
    ident = F.when(F.col("id_type") == "uid", F.col("uid")).otherwise(
        F.try_element_at(F.col("ext"), F.col("id_type")))
    out = exploded.withColumn("id", ident)
    return out.where(not_blank(F.col("id")))


def strip_id_prefix(col):
    """Windowed path: drop everything through the first ``:`` of the id."""
    return F.substr(col, F.instr(col, F.lit(":")) + F.lit(1))
