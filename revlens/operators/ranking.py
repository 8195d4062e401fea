"""Top-k and a global rank without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.session import scratch_path


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows of a total order (each task keeps only its own ``k``)."""
    return df.orderBy(*order).limit(k)


def rank_descending(df: DataFrame, value: str, rank: str) -> DataFrame:
    """``rank() over (order by value desc)`` as bigint, ties sharing a rank.

    Rows with an equal value share their rank, so only the distinct values are ordered, with
    how often each occurs. They are range-partitioned and ranked within their slice; a slice
    adds what the ones before it hold. The rows and the slices are written first, so that
    neither is computed twice and a task run again finds the same ones. No window spans all
    values and no task sees more than its slice.
    """
    spark = df.sparkSession
    rows = scratch_path(spark, "rank-rows")
    df.write.parquet(rows)
    df = spark.read.schema(df.schema).parquet(rows)
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    path = scratch_path(spark, "rank-slices")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sliced = counts.repartitionByRange(width, F.col(value).desc())
    sliced.withColumn("_slice", F.spark_partition_id()).write.parquet(path)
    slices = spark.read.parquet(path)
    sums = slices.groupBy("_slice").agg(F.sum("_n").alias("_sum"))
    # One row with an entry per slice, which says where each begins.
    every = sums.agg(F.collect_list(F.struct("_slice", "_sum")).alias("_all"))

    def start(own):
        earlier = F.filter("_all", lambda s: s["_slice"] < own["_slice"])
        total = F.aggregate(earlier, F.lit(0).cast("bigint"), lambda total, s: total + s["_sum"])
        return F.struct(own["_slice"].alias("_slice"), total.alias("_start"))

    starts = every.select(F.inline(F.transform("_all", start)))
    before = Window.partitionBy("_slice").orderBy(F.col(value).desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranks = slices.join(starts, "_slice").select(
        F.col(value).alias("_value"),
        (F.col("_start") + F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).cast("bigint").alias(rank),
    )
    return df.join(ranks, df[value].eqNullSafe(ranks["_value"])).drop("_value")
