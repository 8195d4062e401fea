"""Column functions with the warehouse's semantics, all built from JVM-side expressions."""

from revlens.functions.dates import (
    calendar_date,
    date_key,
    epoch_floor,
    is_weekend,
    month_name,
    month_start,
)
from revlens.functions.keys import surrogate_key
from revlens.functions.nested import element_or_null, json_scalar
from revlens.functions.numbers import ratio, round_half_away, strict_double, try_double
from revlens.functions.text import is_blank, strip_line, trim_whitespace

__all__ = [
    "calendar_date",
    "date_key",
    "element_or_null",
    "epoch_floor",
    "is_blank",
    "is_weekend",
    "json_scalar",
    "month_name",
    "month_start",
    "ratio",
    "round_half_away",
    "strict_double",
    "strip_line",
    "surrogate_key",
    "trim_whitespace",
    "try_double",
]
