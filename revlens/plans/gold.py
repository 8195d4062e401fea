"""The five marts.

The fact is reduced before it meets a dimension wherever the measure allows it.
Reviews are counted as rows: ``review_sk`` is never null (it hashes a token for a
null), so the 32-byte key column need not be read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions import is_blank, month_name, ratio, round_half_away
from revlens.operators.joins import join_dimension
from revlens.operators.ranking import rank_descending, top_k

TOP_CATEGORIES = 5
MIN_REVIEWERS = 10

# Upper bound (inclusive) and label of each bucket of review counts.
REVIEW_BUCKETS = [
    (1, "1 review"),
    (5, "2-5 reviews"),
    (10, "6-10 reviews"),
    (20, "11-20 reviews"),
    (50, "21-50 reviews"),
    (100, "51-100 reviews"),
    (500, "101-500 reviews"),
    (None, "500+ reviews"),
]


def category_product_counts(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Reviewed products per category.

    A product has one category, so counting distinct reviewed products means
    joining each reviewed id once; the fact's rows collapse to ids on the map side.
    """
    reviewed = fact.select("product_id").distinct()
    categorised = products.where(F.col("primary_category").isNotNull())
    return (
        reviewed.join(categorised.select("product_id", "primary_category"), "product_id")
        .groupBy("primary_category")
        .agg(F.count(F.lit(1)).alias("product_count"))
    )


def top_categories(
    fact: DataFrame, products: DataFrame, k: int = TOP_CATEGORIES
) -> DataFrame:
    """Categories with the most reviewed products; ties by name."""
    counts = category_product_counts(fact, products)
    return top_k(counts, k, F.col("product_count").desc(), F.col("primary_category"))


def products_in_top_categories(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Products (id and category) of the top categories."""
    top = top_categories(fact, products).select("primary_category")
    return products.select("product_id", "primary_category").join(
        top, "primary_category", "left_semi"
    )


def category_ratings_monthly(
    fact: DataFrame, products: DataFrame, dates: DataFrame
) -> DataFrame:
    """Average rating per month and top category."""
    chosen = products_in_top_categories(fact, products)
    rated = join_dimension(fact.select("product_id", "date_id", "rating"), chosen, "product_id")
    # Sums per day and category first: the date join then sees one row per day.
    daily = rated.groupBy("date_id", "primary_category").agg(
        F.sum("rating").alias("rating_sum"), F.count("rating").alias("ratings")
    )
    monthly = daily.join(dates.select("date_id", "year_month"), "date_id")
    total, count = F.sum("rating_sum"), F.sum("ratings")
    return monthly.groupBy("year_month", "primary_category").agg(
        F.when(count > 0, total / count).alias("avg_rating")
    )


def brand_review_counts(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Reviews, reviewers and reviews per reviewer of each non-blank brand."""
    branded = products.where(~is_blank(F.col("brand"))).select("product_id", "brand")
    reviews = join_dimension(fact.select("product_id", "reviewer_id"), branded, "product_id")
    # Combining per (brand, reviewer) keeps one busy brand spread over all tasks.
    per_reviewer = reviews.groupBy("brand", "reviewer_id").agg(
        F.count("reviewer_id").alias("reviews")
    )
    counts = per_reviewer.groupBy("brand").agg(
        F.sum("reviews").alias("total_reviews"),
        F.count("reviewer_id").alias("unique_reviewers"),
    )
    average = ratio(F.col("total_reviews"), F.col("unique_reviewers"))
    return counts.withColumn("avg_reviews_per_reviewer", round_half_away(average))


def with_enough_reviewers(brands: DataFrame, minimum: int = MIN_REVIEWERS) -> DataFrame:
    return brands.where(F.col("unique_reviewers") >= minimum)


def brand_repeated_reviewers(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Brands with enough reviewers, ranked by reviews per reviewer."""
    brands = with_enough_reviewers(brand_review_counts(fact, products))
    return rank_descending(brands, "avg_reviews_per_reviewer", "brand_rank")


def _by_bucket(count: Column, values: list) -> Column:
    """The value of the first bucket whose upper bound reaches ``count``."""
    chosen = None
    for (upper, _), value in zip(REVIEW_BUCKETS[:-1], values[:-1], strict=True):
        hit = F.lit(value)
        # A count below one matches no bucket but the last.
        condition = count.between(1, upper)
        chosen = F.when(condition, hit) if chosen is None else chosen.when(condition, hit)
    return chosen.otherwise(F.lit(values[-1]))


def review_bucket_label(count: Column) -> Column:
    return _by_bucket(count, [label for _, label in REVIEW_BUCKETS])


def review_bucket_order(count: Column) -> Column:
    orders = list(range(1, len(REVIEW_BUCKETS) + 1))
    return _by_bucket(count, orders).cast("bigint")


def review_counts(fact: DataFrame) -> DataFrame:
    """Reviews per reviewer."""
    return fact.groupBy("reviewer_id").agg(F.count(F.lit(1)).alias("review_count"))


def reviews_per_reviewer(fact: DataFrame) -> DataFrame:
    """Reviews per reviewer with their bucket."""
    count = F.col("review_count")
    return review_counts(fact).select(
        "reviewer_id",
        "review_count",
        review_bucket_label(count).alias("review_bucket"),
        review_bucket_order(count).alias("bucket_order"),
    )


def monthly_aggregates(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Review count and average helpful votes per calendar month."""
    daily = fact.groupBy("date_id").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.sum("helpful_votes").alias("helpful"),
        F.count("helpful_votes").alias("voted"),
    )
    voted = F.sum("voted")
    return (
        daily.join(dates.select("date_id", "year", "month"), "date_id")
        .groupBy("year", "month")
        .agg(
            F.sum("reviews").alias("monthly_review_count"),
            F.when(voted > 0, ratio(F.sum("helpful"), voted)).alias("monthly_avg_helpful_votes"),
        )
    )


def seasonality_and_reviews(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Per month of the year: totals, and plain averages over its years."""
    by_month = monthly_aggregates(fact, dates).groupBy("month")
    return by_month.agg(
        F.sum("monthly_review_count").alias("total_reviews"),
        round_half_away(F.avg("monthly_review_count")).alias("avg_reviews_per_month"),
        round_half_away(F.avg("monthly_avg_helpful_votes")).alias("avg_helpful_votes"),
    ).select(
        "month",
        month_name(F.col("month")).alias("month_name"),
        "total_reviews",
        "avg_reviews_per_month",
        "avg_helpful_votes",
    )


def weekend_review_behavior(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Reviews on weekends and weekdays, per day that has a review."""
    daily = fact.groupBy("date_id").agg(F.count(F.lit(1)).alias("reviews"))
    days = daily.join(dates.select("date_id", "date_day", "is_weekend"), "date_id")
    totals = days.groupBy("is_weekend").agg(
        F.sum("reviews").alias("total_reviews"),
        F.countDistinct("date_day").alias("total_days"),
    )
    average = ratio(F.col("total_reviews"), F.col("total_days"))
    return totals.select(
        F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type"),
        "total_reviews",
        "total_days",
        round_half_away(average).alias("avg_reviews_per_day"),
    )


# Column each mart is read by, and whether ascending ("Weekend" sorts after "Weekday").
READING_ORDER = {
    "brand_repeated_reviewers": ("avg_reviews_per_reviewer", False),
    "seasonality_and_reviews": ("month", True),
    "weekend_review_behavior": ("day_type", False),
}


def in_reading_order(mart: DataFrame, name: str) -> DataFrame:
    """A mart sorted for display; stored tables need no order, so builds skip it."""
    column, ascending = READING_ORDER[name]
    return mart.orderBy(column, ascending=ascending)
