"""Field expressions in feature specs.

A spec names the value it aggregates with an expression over the event:
``uid``, ``eventType``, ``ext.pay`` (a key of the ``ext`` map) or any Spark
SQL expression over the event's fields (``ext.pay * 2``, ``upper(bizType)``,
``pay.amount``).

Plain paths are resolved *data-driven*: the path string travels with each
routed row and is looked up with ``try_element_at`` on the event maps, so a
thousand specs still compile to one plan.  Only expressions that are not plain
paths are compiled into the plan, one ``CASE`` branch per distinct text.  Each is
first resolved on an empty frame, so one that cannot be is reported with its
spec and the others go on.

Next to an arithmetic operator an ``ext`` value is a number: whole numbers stay
whole, others are doubles, and text that is no number makes the value NULL for
that row only.
"""

from __future__ import annotations

import re
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

_IDENT = r"[A-Za-z_][A-Za-z0-9_]*"
_PLAIN = re.compile(rf"^(ext\.)?{_IDENT}$")


def is_plain_path(expr: str | None) -> bool:
    return expr is not None and bool(_PLAIN.match(expr.strip()))


def _plain_lookup(path: Column) -> Column:
    """Value of a plain path held in a string column (NULL when absent)."""
    trimmed = F.trim(path)
    in_ext = trimmed.startswith("ext.")
    ext_key = F.substring(trimmed, 5, 1 << 20)
    return F.when(in_ext, F.try_element_at(F.col("ext"), ext_key)).otherwise(
        F.try_element_at(F.col("attrs"), trimmed)
    )


def field_value(path: Column, compiled: dict[str, str] | None = None) -> Column:
    """String value of the spec expression held in ``path`` for each row.

    ``compiled`` maps expression text -> Spark SQL for the non-plain
    expressions present in the spec set (built by the spec compiler).
    """
    value = _plain_lookup(path)
    if compiled:
        branches = None
        for text, sql in sorted(compiled.items()):
            cond = path == F.lit(text)
            expr = F.expr(sql)
            branches = F.when(cond, expr) if branches is None else branches.when(cond, expr)
        value = branches.otherwise(value)
    return value


# Envelope fields under their names in a spec.
_ENVELOPE = {"bizType": "biz_type", "eventType": "event_type", "targetType": "target_type"}
_QUOTED = re.compile(r"('(?:[^'\\]|\\.|'')*'|\"[^\"]*\")")
# an ext value next to an arithmetic operator is read as a number
_OPERAND = re.compile(rf"(?<![\w.])ext\.({_IDENT})(?=\s*\)*\s*[-+*/%])|(?<=[-+*/%])(\s*\(*\s*)ext\.({_IDENT})(?!\w|\.)")


def _outside_quotes(text: str, change) -> str:
    return "".join(part if i % 2 else change(part) for i, part in enumerate(_QUOTED.split(text)))


def _with_numbers(text: str, read: str) -> str:
    def number(m):
        return (m.group(2) or "") + read.format(key=m.group(1) or m.group(3))
    return _outside_quotes(text, lambda part: _OPERAND.sub(number, part))


_WHOLE = "CAST(try_cast(try_element_at(ext, '{key}') AS BIGINT) AS DECIMAL(19,0))"
_DOUBLE = "try_cast(try_element_at(ext, '{key}') AS DOUBLE)"


def nested_path_sql(text: str) -> str | None:
    """SQL for ``ext.a.b`` or ``pay.amount``: a path into the JSON text kept in a map; None for anything else."""
    m = re.match(rf"^({_IDENT})((?:\.{_IDENT})+)$", text.strip())
    if not m:
        return None
    first, rest = m.group(1), m.group(2)
    if first != "ext":
        return f"get_json_object(try_element_at(attrs, '{first}'), '${rest}')"
    key, _, below = rest[1:].partition(".")
    return f"get_json_object(try_element_at(ext, '{key}'), '$.{below}')" if below else None


@contextmanager
def lenient(spark):
    """While a projection of spec expressions is built: a bad value, a zero divisor or an overflow gives NULL for that row.

    Casts and arithmetic keep the mode they were analysed in, so only
    projections built inside are affected.
    """
    key = "spark.sql.ansi.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class ExpressionChecker:
    """Resolves spec expressions on an empty event frame, one by one."""

    def __init__(self, spark):
        self.spark = spark
        self.frame = spark.range(0).selectExpr(
            "'' AS uid", "'' AS biz_type", "'' AS event_type", "'' AS target_type", "0L AS event_ms",
            "CAST(NULL AS map<string,string>) AS ext", "CAST(NULL AS map<string,string>) AS attrs")

    def _type(self, sql: str):
        with lenient(self.spark):
            df = self.frame.select("uid", F.expr(f"CASE WHEN uid = '' THEN ({sql}) END").alias("v"))
        return df.schema["v"].dataType

    def _resolved(self, sql: str) -> str:
        """``sql`` with unknown plain names read from the event's top-level fields."""
        for _ in range(50):
            try:
                self._type(sql)
                return sql
            except AnalysisException as e:
                name = ((e.getMessageParameters() or {}).get("objectName") or "").replace("`", "")
                if not str(e.getCondition() or "").startswith("UNRESOLVED_COLUMN") or not re.fullmatch(_IDENT, name):
                    raise
                sql = _outside_quotes(sql, lambda part, n=name: re.sub(rf"(?<![\w.]){n}(?!\w)", f"try_element_at(attrs, '{n}')", part))
        raise ValueError("too many unknown names")

    def sql(self, text: str) -> str:
        """SQL that yields the expression's string value; raises if it cannot be resolved."""
        nested = nested_path_sql(text)
        if nested:
            return nested
        named = _outside_quotes(text.strip(), lambda part: re.sub(
            r"(?<![\w.])(" + "|".join(_ENVELOPE) + r")(?!\w)", lambda m: _ENVELOPE[m.group(1)], part))
        whole = self._resolved(_with_numbers(named, _WHOLE))
        kind = self._type(whole)
        if isinstance(kind, DecimalType):
            double = self._resolved(_with_numbers(named, _DOUBLE))
            return (f"coalesce(CASE WHEN ({whole}) = floor({whole}) THEN CAST(CAST(({whole}) AS DECIMAL(38,0)) AS STRING) END, "
                    f"CAST(({double}) AS STRING))")
        return f"CAST(({whole}) AS STRING)"


def compile_expressions(spark, texts) -> tuple[dict[str, str], set[str]]:
    """``(text -> SQL, texts that cannot be resolved)`` of the expressions that are no plain paths."""
    known, bad, checker = {}, set(), None
    for text in sorted(t for t in texts if not is_plain_path(t)):
        checker = checker or ExpressionChecker(spark)
        try:
            known[text] = checker.sql(text)
        except (AnalysisException, ValueError):  # includes text that does not parse
            bad.add(text)
    return known, bad
