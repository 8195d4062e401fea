"""Float casts, ratios and rounding that agree with the warehouse."""

from pyspark.sql import Column
from pyspark.sql import functions as F


# Decimal notation, and the names of the special values.
DECIMAL_LITERAL = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)\s*$"


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient in double precision (a ``1.0`` literal would make it DECIMAL)."""
    return numerator.cast("double") / denominator.cast("double")


def round_half_away(value: Column, scale: int = 2) -> Column:
    """Round a non-negative double on its binary value, halves up.

    Spark's ``round`` goes through the shortest decimal text, so 201/200 gives
    1.01 there and 1.0 here and in the warehouse.
    """
    factor = float(10**scale)
    return F.floor(value * factor + 0.5) / F.lit(factor)


def try_double(text: Column) -> Column:
    """Text to double, null where it is no number."""
    return text.try_cast("double")


def strict_double(text: Column) -> Column:
    """Text to double; text that is no number fails the job in any ANSI mode.

    Only decimal literals, infinities and NaN are numbers; the JVM's own forms (``1.5d``,
    ``0x1p3``) are not.
    """
    number = F.when(text.rlike(DECIMAL_LITERAL), try_double(text))
    message = F.concat(F.lit("not a number: "), text)
    bad = text.isNotNull() & number.isNull()
    return F.when(bad, F.raise_error(message).cast("double")).otherwise(number)
