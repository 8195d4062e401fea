"""Fact-to-dimension joins that survive a hot key.

No broadcast is forced: Catalyst and adaptive execution broadcast a dimension only
below ``autoBroadcastJoinThreshold`` and otherwise shuffle both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A key with more than this share of the rows is cut into pieces of that size,
# so there are fewer hot keys than HOT_SHARES and the list of them is small.
HOT_SHARES = 1000


def adaptive_skew_join(spark: SparkSession) -> bool:
    """Whether adaptive execution splits oversized join partitions by itself."""
    return all(
        spark.conf.get(key, "true") == "true"
        for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    )


def join_dimension(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Inner join on ``key``; the dimension has one row per key.

    With adaptive skew handling on, the plain join is the best plan: a hot key's
    partition is read in slices. Without it the hot keys are salted.
    """
    if adaptive_skew_join(facts.sparkSession):
        return facts.join(dimension, key)
    return join_salted(facts, dimension, key)


def join_salted(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Inner join on ``key`` with each hot key spread over several tasks.

    A key holding n of N rows gets ceil(n * HOT_SHARES / N) salts if that is more
    than one; its dimension row is repeated once per salt, all other rows once.
    """
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    pieces = F.ceil(F.col("_n") * HOT_SHARES / total).cast("int")
    hot = counts.select(key, pieces.alias("_pieces")).where("_pieces > 1")
    # Fewer than HOT_SHARES rows by construction, so broadcasting them is safe.
    hot = F.broadcast(hot)
    salts = F.coalesce("_pieces", F.lit(1))
    # Content spreads different rows, the sending task spreads equal ones; both are
    # the same again when a lost task is repeated, which a random salt is not.
    spread = F.pmod(F.xxhash64(*facts.columns), salts) + F.spark_partition_id()
    salted_facts = facts.join(hot, key, "left").select(
        *facts.columns, F.pmod(spread, salts).cast("int").alias("_salt")
    )
    salted_dimension = dimension.join(hot, key, "left").select(
        *dimension.columns, F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt")
    )
    return salted_facts.join(salted_dimension, [key, "_salt"]).drop("_salt")
