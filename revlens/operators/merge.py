"""Keyed upsert as a plan of joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Shares into which rows without a key are dealt, as no join needs them together.
KEYLESS_SHARES = 1024


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update_columns: list[str] | None = None,
    within: Column | None = None,
) -> DataFrame:
    """The target after ``MERGE``: matched rows updated, other source rows inserted.

    ``update_columns`` limits what a match updates (default: every column); the
    rest keeps the target's value. A null key never matches. A target row matched
    by several source rows is an error; unmatched source rows are all inserted.

    A full outer join would shuffle the whole target every time and adaptive
    execution can neither broadcast nor split it. Here each join keeps the big
    side streaming: if the source is small, the target is not shuffled at all.

    ``within`` is a condition on target rows that all rows with a key of the source meet (a
    key that holds a time, and the first day of the source). The other rows, also those it is
    null for, pass by the joins as they are, so only the part that can match is shuffled.
    """
    if within is not None:
        inside = F.coalesce(within, F.lit(False))
        merged = merge_upsert(target.where(inside), source, key, update_columns)
        return target.where(~inside).unionByName(merged)
    columns = target.columns
    updated = set(columns if update_columns is None else update_columns) - {key}
    source = source.select(columns)

    # One row per source key, combined before the shuffle; the count finds
    # duplicates. Values are boxed in a struct so that an update to null is kept.
    incoming = (
        source.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*columns)).alias("_new"))
    )
    ambiguous = F.raise_error(
        F.concat(F.lit(f"several source rows match {key} = "), F.col("_key").cast("string"))
    )
    matched = F.when(F.col("_n") > 1, ambiguous.cast("boolean")).otherwise(
        F.col("_n").isNotNull()
    )
    joined = target.join(incoming, target[key] == incoming["_key"], "left")
    joined = joined.withColumn("_matched", matched)
    kept = joined.select(
        *[
            F.when(F.col("_matched"), F.col("_new")[c]).otherwise(target[c]).alias(c)
            if c in updated
            else F.when(F.col("_matched").isNotNull(), target[c]).alias(c)
            for c in columns
        ]
    )
    # Keys already in the target, one row each, however many rows there bear one: at most
    # as many as the source has, and combined before the shuffle.
    known = (
        target.select(key)
        .join(incoming.select(F.col("_key").alias(key)), key, "left_semi")
        .distinct()
    )
    inserted = source.join(known, key, "left_anti")
    return kept.unionByName(inserted.select(columns))


def merge_whole(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update_columns: list[str] | None = None,
) -> DataFrame:
    """``merge_upsert`` for a source about as large as the target, as one full outer join.

    Each side is read once and shuffled once, on the key: copies of a source key are counted
    by a window on the same partitioning, and rows without a key, which match nothing, are
    spread by content. A key that many target rows bear is one task's stream, not its memory;
    use ``merge_upsert`` where the source is small, as this always shuffles the target.
    """
    columns = target.columns
    updated = set(columns if update_columns is None else update_columns) - {key}

    def keyed(df: DataFrame, side: str) -> DataFrame:
        spread = F.pmod(F.xxhash64(*columns), F.lit(KEYLESS_SHARES)) + 1
        return df.select(
            F.col(key).alias(f"{side}_key"),
            F.when(F.col(key).isNull(), spread).otherwise(0).alias(f"{side}_share"),
            F.struct(*columns).alias(side),
        )

    copies = Window.partitionBy("new_key", "new_share")
    incoming = keyed(source.select(columns), "new").withColumn("_n", F.count(F.lit(1)).over(copies))
    stored = keyed(target, "old")
    same = (F.col("old_key") == F.col("new_key")) & (F.col("old_share") == F.col("new_share"))
    joined = stored.join(incoming, same, "full")
    ambiguous = F.raise_error(
        F.concat(F.lit(f"several source rows match {key} = "), F.col("new_key").cast("string"))
    )
    known, given = F.col("old").isNotNull(), F.col("new").isNotNull()
    clash = F.when(known & (F.col("_n") > 1), ambiguous.cast("boolean")).otherwise(known & given)
    joined = joined.withColumn("_matched", clash)
    return joined.select(
        *[
            F.when(F.col("_matched") & F.lit(c in updated), F.col("new")[c])
            .when(known, F.col("old")[c])
            .otherwise(F.col("new")[c])
            .alias(c)
            for c in columns
        ]
    )
