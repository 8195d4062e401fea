"""Whitespace handling beyond the space-only ``trim`` of Spark."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python's ``str.strip`` removes, from the rule itself.
LINE_WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# The Unicode White_Space property: the same without the four separators.
WHITE_SPACE = "".join(c for c in LINE_WHITESPACE if not "\x1c" <= c <= "\x1f")


def strip_line(line: Column) -> Column:
    """``str.strip``: every kind of whitespace off both ends."""
    return F.trim(line, F.lit(LINE_WHITESPACE))


def trim_whitespace(text: Column) -> Column:
    """SQL ``trim(text)`` of a warehouse that trims all Unicode whitespace."""
    return F.trim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    """True for null, empty or whitespace-only text; never null."""
    return text.isNull() | (trim_whitespace(text) == "")
