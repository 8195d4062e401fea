"""Data checks: each returns the rows (or groups of rows) that break a rule.

Null values pass every check except ``not_null``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.where(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with how often."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def outside_values(column: str, accepted: list) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(accepted)


def check_accepted_values(df: DataFrame, column: str, accepted: list) -> DataFrame:
    """Values outside the list, with how often they occur."""
    bad = df.where(outside_values(column, accepted)).groupBy(column)
    return bad.agg(F.count(F.lit(1)).alias("n_records"))


def check_relationship(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child values without a parent, with the number of child rows.

    Child rows collapse to one per value first, so the anti join has no hot key.
    """
    values = child.where(F.col(column).isNotNull()).groupBy(column)
    counts = values.agg(F.count(F.lit(1)).alias("n_records"))
    keys = parent.select(F.col(parent_column).alias(column))
    return counts.join(keys, column, "left_anti")


def outside_range(value: Column, low, high) -> Column:
    return value.isNotNull() & ~value.between(low, high)


def check_between(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows whose value lies outside the inclusive range."""
    return df.where(outside_range(F.col(column), low, high))


def check_length_between(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    """Rows whose text has a length (in characters) outside the inclusive range."""
    return df.where(outside_range(F.char_length(column), low, high))


def more_helpful_than_total() -> Column:
    return F.col("helpful_votes") > F.col("total_votes")


def check_helpful_votes(fact: DataFrame) -> DataFrame:
    """Reviews with more helpful votes than votes."""
    return fact.where(more_helpful_than_total()).select(
        "review_sk", "helpful_votes", "total_votes"
    )


def check_no_future_reviews(fact: DataFrame, as_of: dt.date) -> DataFrame:
    """Reviews dated after ``as_of``."""
    return fact.where(F.col("review_date") > F.lit(as_of)).select(
        "review_sk", "review_date", F.lit(as_of).alias("today")
    )
