"""The star schema: date, product and reviewer dimensions, review fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions import (
    calendar_date,
    date_key,
    element_or_null,
    epoch_floor,
    is_weekend,
    json_scalar,
    month_start,
    surrogate_key,
)
from revlens.operators.dedup import keep_first, latest_name, nulls_last_flags
from revlens.plans.bronze import stamp

# What a later run may change; the other columns keep their first value.
PRODUCT_UPDATES = [
    "product_name",
    "brand",
    "price_usd",
    "product_description",
    "primary_category",
    "detailed_categorization",
    "_loaded_at",
]
REVIEWER_UPDATES = ["reviewer_name", "_loaded_at"]

LOOKBACK_DAYS = 3

# Epoch seconds of 0001-01-01 00:00:00 and 9999-12-31 23:59:59.
CALENDAR_SECONDS = (-62135596800, 253402300799)


def _calendar_seconds(seconds: Column) -> Column:
    """Fail on a time no calendar date can hold, which also bounds the date spine."""
    error = F.raise_error(F.lit("review time outside the years 1 to 9999")).cast("bigint")
    return F.when(~seconds.between(*CALENDAR_SECONDS), error).otherwise(seconds)


def date_bounds(reviews: DataFrame) -> DataFrame:
    """One row: first and last review day (nulls if no review has a time)."""
    bounds = reviews.agg(
        F.min("unix_review_time").alias("first"), F.max("unix_review_time").alias("last")
    )
    return bounds.select(
        calendar_date(_calendar_seconds(F.col("first"))).alias("start_date"),
        calendar_date(_calendar_seconds(F.col("last"))).alias("end_date"),
    )


def date_spine(reviews: DataFrame) -> DataFrame:
    """Every day from the first to the last review."""
    days = F.sequence("start_date", "end_date", F.expr("INTERVAL 1 DAY"))
    return date_bounds(reviews).select(F.explode(days).alias("date_day"))


def dim_date(reviews: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    day = F.col("date_day")
    return date_spine(reviews).select(
        date_key(day).alias("date_id"),
        day,
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month"),
        F.dayofmonth(day).cast("bigint").alias("day"),
        month_start(day).alias("year_month"),
        F.dayofweek(day).cast("bigint").alias("day_of_week"),
        is_weekend(day).alias("is_weekend"),
        stamp(loaded_at),
    )


def without_negative_price(products: DataFrame) -> DataFrame:
    """Negative prices out, missing prices kept (NaN compares as largest in Spark)."""
    price = F.col("price_usd")
    return products.where(price.isNull() | ((price >= 0) & ~F.isnan(price)))


def dedup_products(products: DataFrame) -> DataFrame:
    """The most complete row per product; equal ones by name, then by content."""
    kept = products.select(
        "product_id",
        "product_name",
        "brand",
        "price_usd",
        "product_description",
        "image_url",
        "categories_json",
    )
    flags = nulls_last_flags(
        "categories_json", "product_description", "brand", "price_usd", "image_url"
    )
    ties = [
        F.col(c).asc_nulls_last()
        for c in (
            "product_name",
            "categories_json",
            "product_description",
            "brand",
            "price_usd",
            "image_url",
        )
    ]
    return keep_first(kept, "product_id", *flags, *ties)


def dim_products(products: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    return dedup_products(without_negative_price(products)).select(
        "product_id",
        "product_name",
        "product_description",
        "brand",
        "price_usd",
        "image_url",
        json_scalar(F.col("categories_json"), "$[0][0]").alias("primary_category"),
        F.col("categories_json").alias("detailed_categorization"),
        stamp(loaded_at),
    )


def dim_reviewer(reviews: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Newest non-null name and first review time (epoch seconds) per reviewer."""
    reviewers = latest_name(
        reviews, "reviewer_id", "reviewer_name", "unix_review_time", "first_review_timestamp"
    )
    return reviewers.select(
        "reviewer_id", "reviewer_name", "first_review_timestamp", stamp(loaded_at)
    )


def with_keys(reviews: DataFrame) -> DataFrame:
    """Reviews that have a time, a reviewer and a product."""
    return reviews.where(
        F.col("unix_review_time").isNotNull()
        & F.col("reviewer_id").isNotNull()
        & F.col("product_id").isNotNull()
    )


def recent(reviews: DataFrame, as_of: dt.date, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Reviews from the day ``days`` before ``as_of`` on (the late-arrival window)."""
    return reviews.where(F.col("unix_review_time") >= F.lit(epoch_floor(as_of, days)))


_REVIEW_KEY = ("reviewer_id", "product_id", "unix_review_time")


def _measures(reviews: DataFrame, incremental_as_of: dt.date | None) -> DataFrame:
    """The keyed (and recent) reviews with what the fact's columns are made of."""
    keyed = with_keys(reviews)
    if incremental_as_of is not None:
        keyed = recent(keyed, incremental_as_of)
    return keyed.select(
        *_REVIEW_KEY,
        "rating",
        element_or_null(F.col("helpful_array"), 0).cast("bigint").alias("helpful_votes"),
        element_or_null(F.col("helpful_array"), 1).cast("bigint").alias("total_votes"),
        "review_summary",
        F.col("reviewer_text").alias("review_text"),
    )


def fact_columns() -> list[Column | str]:
    """The fact's columns from those of ``unique_reviews``."""
    day = calendar_date(F.col("unix_review_time"))
    return [
        surrogate_key(*_REVIEW_KEY).alias("review_sk"),
        "reviewer_id",
        "product_id",
        date_key(day).alias("date_id"),
        day.alias("review_date"),
        "rating",
        "helpful_votes",
        "total_votes",
        "review_summary",
        "review_text",
        F.timestamp_seconds("unix_review_time").alias("review_timestamp"),
    ]


def fct_review(reviews: DataFrame, incremental_as_of: dt.date | None = None) -> DataFrame:
    """One row per keyed review; an incremental run takes only the recent days."""
    return _measures(reviews, incremental_as_of).select(*fact_columns())


def unique_reviews(reviews: DataFrame, incremental_as_of: dt.date | None = None) -> DataFrame:
    """What ``fact_columns`` needs, one row per review key, chosen by content; and ``review_date``.

    So rows are shuffled before the key's text and the dates are made, which take most of a
    fact row; the key travels as the bytes behind its text.
    """
    measures = _measures(reviews, incremental_as_of)
    order = [F.col(c).asc_nulls_last() for c in measures.columns]
    keyed = measures.withColumn("_key", F.unhex(surrogate_key(*_REVIEW_KEY)))
    kept = keep_first(keyed, "_key", *order).drop("_key")
    return kept.withColumn("review_date", calendar_date(F.col("unix_review_time")))


def unique_fct_review(reviews: DataFrame, incremental_as_of: dt.date | None = None) -> DataFrame:
    """``fct_review`` with one row per review key, chosen by content."""
    return unique_reviews(reviews, incremental_as_of).select(*fact_columns())
