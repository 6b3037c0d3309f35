"""Valid-time text: date-only values widen to the start or end of their day, and all
comparison is on the text.

Arguments named ``c``, ``key``, ``valid_from`` and ``valid_to`` are column names or SQL
expressions. The rules are written as SQL text, so that building a plan from them is cheap.
"""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings and the widening suffixes.
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2}))?$"
DAY_START = "T00:00:00Z"
DAY_END = "T23:59:59Z"


def _widened(c: str, suffix: str) -> str:
    date_only = f"octet_length({c}) = 10 AND substring({c}, 5, 1) = '-' AND substring({c}, 8, 1) = '-'"
    return f"CASE WHEN {date_only} THEN concat({c}, '{suffix}') ELSE {c} END"


def start_key(c: str) -> Column:
    return F.expr(_widened(c, DAY_START))


def end_key(c: str) -> Column:
    return F.expr(_widened(c, DAY_END))


def key_of(value: str, suffix: str = DAY_START) -> str:
    """The same widening for one Python value."""
    date_only = len(value.encode()) == 10 and value[4:5] == "-" and value[7:8] == "-"
    return value + suffix if date_only else value


def check_temporal(value, name):
    """Pass None, "" and well-formed values; refuse anything else."""
    if value and not re.match(ISO_PATTERN, value):
        raise ValueError(f"{name}={value!r} is not an ISO date or date-time")
    return value


def malformed(c: str) -> str:
    """SQL condition: given, but not an ISO date or date-time."""
    return f"({c} IS NOT NULL AND NOT {c} RLIKE r'{ISO_PATTERN}')"


def is_temporal(c: str) -> Column:
    """True for NULL and for well-formed text."""
    return ~F.expr(malformed(c))


def valid_at(key: str, valid_from: str = "valid_from", valid_to: str = "valid_to") -> Column:
    """Closed interval containing the key; a NULL end is unbounded."""
    return F.expr(
        f"({valid_from} IS NULL OR {_widened(valid_from, DAY_START)} <= {key}) "
        f"AND ({valid_to} IS NULL OR {_widened(valid_to, DAY_END)} >= {key})"
    )


def apply_as_of(df, as_of):
    """Rows valid at ``as_of``; None or "" keeps every row."""
    if not check_temporal(as_of, "as_of"):
        return df
    return df.filter(valid_at(f"'{key_of(as_of)}'"))


def inverted(valid_from: str = "valid_from", valid_to: str = "valid_to") -> str:
    """SQL condition: the interval ends before it starts (never NULL)."""
    return f"coalesce({_widened(valid_to, DAY_END)} < {_widened(valid_from, DAY_START)}, false)"
