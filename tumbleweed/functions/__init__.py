from tumbleweed.functions.intervals import parse_interval_ms, INTERVAL_SQL_PATTERN
from tumbleweed.functions.fields import field_value, is_plain_path
from tumbleweed.functions.scalars import (
    pane_end_ms, local_day_num, row_key, timestamped_value, blank, not_blank,
)

__all__ = [
    "parse_interval_ms", "INTERVAL_SQL_PATTERN", "field_value", "is_plain_path",
    "pane_end_ms", "local_day_num", "row_key", "timestamped_value", "blank", "not_blank",
]
