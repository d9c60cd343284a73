"""Window / delay strings such as ``10m``, ``3h``, ``1min``, ``7d``.

Accepted units (decision D12): s, m / min, h, d.  Anything else is a
validation error, reported by the spec compiler rather than silently dropped.
"""

from __future__ import annotations

import re

# Unit spellings and their length in milliseconds.
UNIT_MS = {"s": 1_000, "m": 60_000, "min": 60_000, "h": 3_600_000, "d": 86_400_000}

# The grammar as a regular expression (also usable with rlike in SQL).
INTERVAL_SQL_PATTERN = r"^([0-9]+)(s|m|min|h|d)$"
_PATTERN = re.compile(INTERVAL_SQL_PATTERN)

# Whole-day window names (windowType = wholeWindow).
WHOLE_WINDOWS = ("today", "yesterday")


def parse_interval_ms(text: str | None) -> int | None:
    """``'10m'`` -> 600000; ``None`` for anything outside the grammar."""
    if text is None:
        return None
    m = _PATTERN.match(text.strip())
    if not m:
        return None
    n = int(m.group(1))
    return n * UNIT_MS[m.group(2)] if n > 0 else None


def duration_ms(value: str | int) -> int:
    """Milliseconds of a number, of ``'10m'``, or of a phrase such as ``'1 minute'`` or ``'90 seconds'``."""
    if isinstance(value, int):
        return value
    number, _, unit = value.strip().partition(" ")
    short = {"second": "s", "minute": "m", "hour": "h", "day": "d"}.get(unit.strip().rstrip("s"))
    found = parse_interval_ms(number + short if short else value)
    if found is None:
        if number == "0":
            return 0
        raise ValueError(f"not a duration: {value!r}")
    return found
