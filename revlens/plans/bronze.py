"""Landing tables renamed and cast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions import strict_double, try_double


def stamp(loaded_at: Column | None = None) -> Column:
    """The load-time column; pass a value to repeat a run."""
    return (F.current_timestamp() if loaded_at is None else loaded_at).alias("_loaded_at")


def bronze_products(
    landing: DataFrame, loaded_at: Column | None = None, strict_price: bool = True
) -> DataFrame:
    """Product rows; a price that is no number fails (or is null if not strict)."""
    price = strict_double if strict_price else try_double
    return landing.select(
        F.col("asin").alias("product_id"),
        F.col("title").alias("product_name"),
        F.col("description").alias("product_description"),
        "brand",
        price(F.col("price")).alias("price_usd"),
        F.col("imUrl").alias("image_url"),
        F.col("categories").alias("categories_json"),
        F.col("salesRank").alias("sales_rank_json"),
        F.col("related").alias("related_products_json"),
        stamp(loaded_at),
    )


def bronze_reviews(landing: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Review rows with numeric rating and epoch seconds."""
    return landing.select(
        F.col("reviewerID").alias("reviewer_id"),
        F.col("asin").alias("product_id"),
        F.col("reviewerName").alias("reviewer_name"),
        F.col("reviewText").alias("reviewer_text"),
        F.col("summary").alias("review_summary"),
        F.col("overall").cast("double").alias("rating"),
        F.col("helpful").alias("helpful_array"),
        F.col("unixReviewTime").cast("bigint").alias("unix_review_time"),
        F.col("reviewTime").alias("review_time_raw"),
        stamp(loaded_at),
    )
