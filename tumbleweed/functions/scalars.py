"""Small column helpers used across operators (all built-in expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank(col: Column) -> Column:
    """True when NULL, empty or white space only, tabs and line ends included."""
    return ~F.coalesce(col.rlike(r"[^\s\x1c-\x1f]"), F.lit(False))


def not_blank(col: Column) -> Column:
    return ~blank(col)


def pane_end_ms(event_ms: Column, pane_ms: int) -> Column:
    """End (exclusive) of the fixed-length pane holding ``event_ms``."""
    return (F.floor(event_ms / F.lit(pane_ms)) + 1).cast("bigint") * F.lit(pane_ms)


def local_day_num(ms: Column, tz: str | None = None) -> Column:
    """Calendar day number (days since 1970-01-01) of an epoch-ms instant.

    With ``tz`` the day is taken in that zone, otherwise in the session time
    zone.  Decision D10: the day of a pane is the day of its start.
    """
    ts = F.timestamp_millis(ms)
    if tz:
        ts = F.from_utc_timestamp(F.to_utc_timestamp(ts, F.current_timezone()), tz)
    return F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date"))


def row_key(id_col: Column) -> Column:
    """Serving-store row key: last character of the id, then the id."""
    return F.concat(F.substring(id_col, -1, 1), id_col)


def timestamped_value(ts_ms: Column, value: Column) -> Column:
    """Cache cell text ``ts:<ms>,<value>``."""
    return F.format_string("ts:%d,%s", ts_ms, value)
