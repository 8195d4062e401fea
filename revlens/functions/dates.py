"""UTC dates from epoch seconds.

Dates come from integer arithmetic, so they do not depend on the session time
zone, and no text is formatted and parsed back on the way to a date key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def calendar_date(epoch_seconds: Column) -> Column:
    """The UTC date of a second count; instants before 1970 floor correctly."""
    return F.date_from_unix_date(F.floor(epoch_seconds / SECONDS_PER_DAY).cast("int"))


def date_key(day: Column) -> Column:
    """``yyyymmdd`` as bigint."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def month_start(day: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day, "month")


def is_weekend(day: Column) -> Column:
    """Saturday or Sunday (day 7 or 1 of a week that starts on Sunday)."""
    return F.dayofweek(day).isin(1, 7)


def month_name(month: Column) -> Column:
    """Full English month name of a month number."""
    first = F.make_date(F.lit(2024), month.cast("int"), F.lit(1))
    return F.date_format(first, "MMMM")


def epoch_floor(day: dt.date, days_back: int = 0) -> int:
    """Second count at which the UTC day ``days_back`` before ``day`` begins.

    Comparing the raw epoch column with it keeps a date filter pushable to the
    parquet scan, which a comparison on a derived date is not.
    """
    days = (day - dt.timedelta(days=days_back) - dt.date(1970, 1, 1)).days
    return days * SECONDS_PER_DAY
