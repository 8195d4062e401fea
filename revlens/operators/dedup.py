"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first row of each key in the given order (which must be total).

    Catalyst turns ``row_number() = 1`` into a group limit on both sides of the
    shuffle, so every task sends one row per key: a key with a third of all rows
    does not reach a single reducer.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def nulls_last_flags(*columns: str) -> list[Column]:
    """Sort keys that put rows with a value before rows without one."""
    return [F.col(c).isNull().cast("int") for c in columns]


def latest_name(df: DataFrame, key: str, name: str, time: str, first_time: str) -> DataFrame:
    """Per key: the newest non-null name, and the earliest time.

    One aggregation per (key, name) on plain hash maps, then one over the few
    names of a key. Both combine before their shuffle, so no task ever sees all
    rows of a busy key. Equal newest times fall back to the smallest name; a name
    without any time ranks after those with one.
    """
    per_name = df.where(F.col(key).isNotNull()).groupBy(key, name)
    times = per_name.agg(F.max(time).alias("_newest"), F.min(time).alias("_oldest"))
    order = F.struct(
        F.col(name).isNull(),
        F.col("_newest").isNull(),
        (-F.col("_newest")).alias("_age"),
        F.col(name),
    )
    return times.groupBy(key).agg(
        F.min_by(name, order).alias(name), F.min("_oldest").alias(first_time)
    )
