"""One query per operator, run on the mapped tables.

Load stamps are left out of results (they differ on every run), and the vote array
is shown as text. Queries about files write the whole mapped table below the shared
scratch folder first.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions import epoch_floor, is_blank, strict_double
from revlens.operators import checks
from revlens.operators.joins import join_dimension
from revlens.operators.merge import merge_upsert, merge_whole
from revlens.operators.sampling import sample_keys
from revlens.plans import gold, silver, suite
from revlens.plans.bronze import bronze_products, bronze_reviews
from revlens.schemas import PRODUCT_LANDING, REVIEW_LANDING
from revlens.session import scratch_path
from revlens.sinks import audit, tables
from revlens.sinks import fact as fact_sink
from revlens.sources import landing as landing_source
from revlens.sources import lines as line_source
from revlens.sources import records as record_source
from revlens.streaming import merge_arrivals
from workload import landing

# "Today" of the future check and of the late-arrival window.
AS_OF = dt.date(2001, 7, 1)
# Reviews before this day make up the older state of the reviewer dimension.
REVIEWERS_BEFORE = dt.date(1996, 1, 1)

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    _REGISTRY[run.__name__] = run
    return run


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- tables -----------------------------------------------------------------


@landing.shared
def b_products(spark, d):
    return bronze_products(landing.metadata(spark, d))


@landing.shared
def b_reviews(spark, d):
    return bronze_reviews(landing.items(spark, d))


@landing.shared
def s_dates(spark, d):
    return silver.dim_date(b_reviews(spark, d))


@landing.shared
def s_products(spark, d):
    return silver.dim_products(b_products(spark, d))


@landing.shared
def s_reviewers(spark, d):
    return silver.dim_reviewer(b_reviews(spark, d))


@landing.shared
def s_fact(spark, d):
    return silver.fct_review(b_reviews(spark, d))


@landing.shared
def s_fact_unique(spark, d):
    return silver.unique_fct_review(b_reviews(spark, d))


def s_tables(spark, d):
    return suite.Tables(
        landing.items(spark, d),
        landing.metadata(spark, d),
        s_dates(spark, d),
        s_products(spark, d),
        s_reviewers(spark, d),
        s_fact(spark, d),
    )


def unstamped(df: DataFrame) -> DataFrame:
    return df.drop("_loaded_at")


def array_as_text(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("string"))


def written(lines: DataFrame, label: str, **options) -> str:
    """The lines as text files in a fresh scratch folder."""
    path = scratch_path(lines.sparkSession, label)
    lines.write.text(path, **options)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as a written table: computed once, however often a plan reads it."""
    path = scratch_path(df.sparkSession, label)
    tables.write_table(df, path)
    return tables.read_table(df.sparkSession, path)


def loaded(spark, lines_path: str, label: str, schema=None) -> DataFrame:
    """A line file loaded into a landing table."""
    path = scratch_path(spark, label)
    landing_source.load_table(spark, lines_path, path, schema)
    return tables.read_table(spark, path)


# --- scans, cleaning, loads ---------------------------------------------------


@query
def scan_gzip_lines(spark, d):
    texts = landing.table(spark, d, "documents").select(F.col("text").alias("value"))
    return line_source.read_lines(spark, written(texts, "gzip", compression="gzip"))


@query
def gzip_to_ndjson(spark, d):
    source = written(landing.item_lines(spark, d), "gzip", compression="gzip")
    target = scratch_path(spark, "plain")
    line_source.decompress(spark, source, target)
    return array_as_text(loaded(spark, target, "items", REVIEW_LANDING), "helpful")


@query
def utf8_check(spark, d):
    """Documents of one source get two bytes that are no UTF-8."""
    broken = F.concat(F.encode("text", "UTF-8"), F.lit(b"\xff\xfe")).cast("string")
    lines = landing.table(spark, d, "documents").select(
        "doc_id", F.when(F.col("source") == "src0", broken).otherwise(F.col("text")).alias("value")
    )
    return line_source.invalid_utf8(lines).select("doc_id")


@query
def normalize_lines(spark, d):
    return line_source.normalize_lines(landing.metadata_lines(spark, d))


@query
def parse_json_lines(spark, d):
    lines = normalize_lines(spark, d)
    return lines.withColumn("is_json", record_source.is_strict_json(F.col("value")))


def cleaned(spark, d):
    return record_source.clean_records(normalize_lines(spark, d))


def product_columns(records: DataFrame) -> DataFrame:
    lines = records.select(F.col("record").alias("value"))
    return landing_source.parse_ndjson(lines, PRODUCT_LANDING)


@query
def repair_literal_records(spark, d):
    literals = cleaned(spark, d).where(F.col("route").isin("literal", "repaired"))
    return product_columns(literals).where("NOT _bad").drop("_bad")


@query
def bad_record_report(spark, d):
    return record_source.bad_record_report(cleaned(spark, d))


@query
def canonical_ndjson(spark, d):
    """Records as written, from product lines in all styles and lines with odd numbers and order."""
    lines = landing.metadata_lines(spark, d).unionByName(landing.odd_lines(spark, d))
    source, target = written(lines, "raw"), scratch_path(spark, "ndjson")
    lines = record_source.clean_file(spark, source, target)["output_path"]
    return line_source.read_lines(spark, lines).select(F.col("value").alias("record"))


@query
def rejected_lines(spark, d):
    """Lines without a record as the cleaning left them, and whether the result quotes them."""
    source, target = written(landing.metadata_lines(spark, d), "raw"), scratch_path(spark, "ndjson")
    quoted = record_source.clean_file(spark, source, target)["bad_lines"]
    found = record_source.rejected_lines(spark, target)
    return found.select("line").unionByName(
        spark.createDataFrame([(f"{len(quoted)} quoted",)], "line string")
    )


@query
def rejected_records(spark, d):
    """Records that a load within its budget set aside, with the reason of each."""
    path = scratch_path(spark, "metadata")
    landing_source.load_table(spark, spoilt_products(spark, d), path, PRODUCT_LANDING)
    return tables.rejected_records(spark, path).select("line", "reason")


@query
def ingest_metrics(spark, d):
    source = written(landing.metadata_lines(spark, d), "gzip", compression="gzip")
    result = record_source.clean_file(spark, source, scratch_path(spark, "ndjson"))
    row = (result["status"], result["valid_records"], result["parse_errors"])
    return spark.createDataFrame([row], "status string, valid_records bigint, parse_errors bigint")


@query
def load_metadata(spark, d):
    source, target = written(landing.metadata_lines(spark, d), "raw"), scratch_path(spark, "ndjson")
    lines = record_source.clean_file(spark, source, target)["output_path"]
    return loaded(spark, lines, "metadata", PRODUCT_LANDING)


@query
def load_inferred(spark, d):
    path = written(landing.item_lines(spark, d), "ndjson")
    rows = loaded(spark, path, "items").select(*REVIEW_LANDING.fieldNames())
    return array_as_text(rows, "helpful")


def spoilt_products(spark, d) -> str:
    """The product lines as a file, four of them spoilt (a budget of ten allows that)."""
    products = landing.metadata(spark, d)
    line = F.to_json(F.struct(*products.columns))
    spoilt = (
        F.when(F.col("asin") == "1", F.replace(line, F.lit('"asin"'), F.lit('"ASIN_"')))
        .when(F.col("asin") == "2", F.concat(line, F.lit(" trailing")))
        .when(F.col("asin") == "3", F.concat(F.lit("["), line, F.lit("]")))
        .when(F.col("asin") == "4", F.replace(line, F.lit('"asin"'), F.lit('"unknown":1,"asin"')))
        .when(F.col("asin") == "5", F.left(line, F.char_length(line) - 1))
        .otherwise(line)
    )
    return written(products.select(spoilt.alias("value")), "ndjson")


@query
def bad_record_budget(spark, d):
    return landing_source.load_landing(spark, spoilt_products(spark, d), PRODUCT_LANDING)


@query
def sample_reviews(spark, d):
    return sample_keys(s_fact(spark, d), "review_sk")


# --- projections, casts, filters ----------------------------------------------


@query
def bronze_products_table(spark, d):
    return unstamped(b_products(spark, d))


@query
def bronze_reviews_table(spark, d):
    return unstamped(array_as_text(b_reviews(spark, d), "helpful_array"))


@query
def cast_price(spark, d):
    price = strict_double(F.col("price")).alias("price_usd")
    return landing.metadata(spark, d).select("asin", "price", price)


@query
def filter_not_null_keys(spark, d):
    keyed = silver.with_keys(b_reviews(spark, d))
    return keyed.select("reviewer_id", "product_id", "unix_review_time")


@query
def filter_negative_price(spark, d):
    kept = silver.without_negative_price(b_products(spark, d))
    return kept.select("product_id", "product_name", "price_usd")


@query
def filter_blank_brand(spark, d):
    products = b_products(spark, d).where(~is_blank(F.col("brand")))
    return products.select("product_id", "brand")


@query
def having_min_reviewers(spark, d):
    return gold.with_enough_reviewers(gold.brand_review_counts(s_fact(spark, d), s_products(spark, d)))


@query
def semi_join_top_categories(spark, d):
    return gold.products_in_top_categories(s_fact(spark, d), s_products(spark, d))


@query
def incremental_lookback(spark, d):
    return silver.fct_review(b_reviews(spark, d), incremental_as_of=AS_OF)


def bucketed(spark, d):
    return gold.review_counts(s_fact(spark, d))


@query
def review_bucket_label(spark, d):
    label = gold.review_bucket_label(F.col("review_count"))
    return bucketed(spark, d).select("reviewer_id", label.alias("review_bucket"))


@query
def review_bucket_order(spark, d):
    order = gold.review_bucket_order(F.col("review_count"))
    return bucketed(spark, d).select("reviewer_id", order.alias("bucket_order"))


# --- joins ----------------------------------------------------------------------


@query
def join_review_product(spark, d):
    fact = s_fact(spark, d).select("review_sk", "product_id", "rating")
    products = s_products(spark, d).select("product_id", "brand", "primary_category")
    return join_dimension(fact, products, "product_id")


@query
def join_review_date(spark, d):
    fact = s_fact(spark, d).select("review_sk", "date_id", "rating")
    dates = s_dates(spark, d).select("date_id", "year_month", "is_weekend")
    return join_dimension(fact, dates, "date_id")


@query
def star_join(spark, d):
    fact = s_fact(spark, d).select("review_sk", "product_id", "date_id", "rating")
    products = s_products(spark, d).select("product_id", "primary_category")
    dates = s_dates(spark, d).select("date_id", "year_month")
    return join_dimension(join_dimension(fact, products, "product_id"), dates, "date_id")


@query
def dim_reviewer(spark, d):
    return unstamped(s_reviewers(spark, d))


@query
def date_spine(spark, d):
    return silver.date_spine(b_reviews(spark, d))


@query
def check_rel_reviewer(spark, d):
    """Reviewers without a name are missing."""
    named = s_reviewers(spark, d).where("reviewer_name IS NOT NULL")
    return checks.check_relationship(s_fact(spark, d), "reviewer_id", named, "reviewer_id")


@query
def check_rel_product(spark, d):
    return checks.check_relationship(
        s_fact(spark, d), "product_id", s_products(spark, d), "product_id"
    )


@query
def check_rel_date(spark, d):
    """Weekends are missing."""
    weekdays = s_dates(spark, d).where("NOT is_weekend")
    return checks.check_relationship(s_fact(spark, d), "date_id", weekdays, "date_id")


# --- aggregations -----------------------------------------------------------------


@query
def date_bounds(spark, d):
    return silver.date_bounds(b_reviews(spark, d))


@query
def first_review_time(spark, d):
    return s_reviewers(spark, d).select("reviewer_id", "first_review_timestamp")


@query
def latest_reviewer_name(spark, d):
    return s_reviewers(spark, d).select("reviewer_id", "reviewer_name")


@query
def reviews_per_reviewer_count(spark, d):
    return gold.review_counts(s_fact(spark, d))


@query
def brand_review_counts(spark, d):
    return gold.brand_review_counts(s_fact(spark, d), s_products(spark, d))


@query
def category_product_counts(spark, d):
    return gold.category_product_counts(s_fact(spark, d), s_products(spark, d))


@query
def monthly_aggregates(spark, d):
    return gold.monthly_aggregates(s_fact(spark, d), s_dates(spark, d))


# --- windows, top-k -----------------------------------------------------------------


@query
def dedup_products(spark, d):
    return silver.dedup_products(silver.without_negative_price(b_products(spark, d)))


@query
def top_categories(spark, d):
    return gold.top_categories(s_fact(spark, d), s_products(spark, d))


# --- merges, writes -------------------------------------------------------------------


def in_window() -> Column:
    """Whether a review falls in the late-arrival window, or later."""
    return F.col("review_date") >= F.lit(AS_OF - dt.timedelta(days=silver.LOOKBACK_DAYS))


def rated_again(fact: DataFrame) -> DataFrame:
    """The reviews of the late-arrival window as they come in a second time, changed."""
    return (
        fact.where(in_window())
        .withColumn("helpful_votes", F.when(F.col("rating") > 1, F.col("helpful_votes") + 1))
        .withColumn("rating", 6 - F.col("rating"))
    )


@query
def merge_fct_review(spark, d):
    """The days since the window opened, re-rated, merged into all reviews before today."""
    fact = stored(s_fact_unique(spark, d), "fact")
    target = fact.where(F.col("review_date") < F.lit(AS_OF))
    # The key holds the review time, so older reviews cannot match.
    return merge_upsert(target, rated_again(fact), "review_sk", within=in_window())


@query
def merge_dim_products(spark, d):
    """Today's products merged into a table that knew those with a category under old values."""
    products = unstamped(s_products(spark, d))
    target = products.where(F.col("primary_category").isNotNull()).select(
        *[
            F.concat(F.lit("old "), c).alias(c) if c in ("product_name", "image_url") else F.col(c)
            for c in products.columns
        ]
    )
    updates = [c for c in silver.PRODUCT_UPDATES if c != "_loaded_at"]
    return merge_whole(target, products, "product_id", updates)


@query
def merge_dim_reviewer(spark, d):
    """All reviewers merged into those of the first year (their first time one day late)."""
    reviews = b_reviews(spark, d)
    seconds = F.lit((REVIEWERS_BEFORE - dt.date(1970, 1, 1)).days * 86400)
    early = unstamped(silver.dim_reviewer(reviews.where(F.col("unix_review_time") < seconds)))
    target = early.withColumn("first_review_timestamp", F.col("first_review_timestamp") + 86400)
    source = unstamped(silver.dim_reviewer(reviews))
    return merge_whole(target, source, "reviewer_id", ["reviewer_name"])


@query
def write_table(spark, d):
    """Products written, then rewritten from the table itself with upper-case names."""
    path = scratch_path(spark, "table")
    tables.write_table(unstamped(b_products(spark, d)), path)
    before = tables.read_table(spark, path)
    tables.write_table(before.withColumn("product_name", F.upper("product_name")), path)
    return tables.read_table(spark, path)


@query
def fct_partitioned(spark, d):
    path = scratch_path(spark, "fact")
    fact_sink.write_fact(s_fact(spark, d), path)
    return fact_sink.with_month(fact_sink.read_fact(spark, path))


@query
def fct_partitioned_merge(spark, d):
    """``merge_fct_review`` on the stored table: only the touched months are rewritten."""
    path = scratch_path(spark, "fact")
    before = b_reviews(spark, d).where(F.col("unix_review_time") < F.lit(epoch_floor(AS_OF)))
    # Copies of a key have its time, so each side is made unique on its own and stored once.
    fact_sink.write_fact(silver.unique_reviews(before), path, columns=silver.fact_columns())
    fact_sink.merge_fact(rated_again(silver.unique_fct_review(b_reviews(spark, d), AS_OF)), path)
    return fact_sink.read_fact(spark, path)


@query
def stream_merge_arrivals(spark, d):
    """Review files arriving in a folder, merged into a new fact table."""
    arrivals = written(landing.item_lines(spark, d), "arrivals", compression="gzip")
    path = scratch_path(spark, "fact")
    merge_arrivals(spark, arrivals, path, scratch_path(spark, "offsets"), AS_OF)
    return fact_sink.read_fact(spark, path)


@query
def run_audit(spark, d):
    """Two load jobs and what the audit table says about them."""
    log = scratch_path(spark, "audit")
    for job, source, schema in (
        ("load_items", written(landing.item_lines(spark, d), "ndjson"), REVIEW_LANDING),
        ("load_metadata", spoilt_products(spark, d), PRODUCT_LANDING),
    ):
        result = landing_source.load_table(spark, source, scratch_path(spark, job), schema)
        audit.append_run(spark, log, job, result, rows=result["rows_loaded"])
    return audit.read_runs(spark, log).select(
        "job", "status", "rows", "bad_records", "input_bytes", "reasons"
    )


# --- checks ---------------------------------------------------------------------------


def staging(spark, d):
    """Staging tables: the reviews since "today", and products that lose the id with the price."""
    items = landing.items(spark, d).where(F.col("unixReviewTime") >= 993945600)
    metadata = landing.metadata(spark, d)
    return items, metadata.withColumn("asin", F.when(F.col("price").isNotNull(), F.col("asin")))


@query
def check_not_null_source(spark, d):
    """All five instances: three on the landing tables, two on the staging ones."""
    items, metadata = staging(spark, d)
    return suite.source_not_null_summary(landing.items(spark, d), landing.metadata(spark, d)).unionByName(
        suite.source_not_null_summary(items, metadata, suite.STAGING)
    )


def with_holes(t: suite.Tables) -> suite.Tables:
    """A column of each table emptied in some rows."""

    def emptied(df: DataFrame, column: str, where: str) -> DataFrame:
        return df.withColumn(column, F.when(~F.coalesce(F.expr(where), F.lit(False)), F.col(column)))

    return dataclasses.replace(
        t,
        dates=emptied(t.dates, "month", "day = 1"),
        products=emptied(t.products, "product_id", "brand IS NULL"),
        reviewers=emptied(t.reviewers, "reviewer_id", "reviewer_name IS NULL"),
        fact=emptied(t.fact, "rating", "helpful_votes > total_votes"),
    )


def twice(df: DataFrame, where: str) -> DataFrame:
    """The rows, some of them a second time."""
    return df.unionByName(df.where(where))


@query
def check_not_null(spark, d):
    return suite.not_null_summary(with_holes(s_tables(spark, d)))


@query
def check_unique_source(spark, d):
    """Both instances, landing and staging."""
    found = {"landing": landing.metadata(spark, d), "staging": twice(staging(spark, d)[1], "brand IS NULL")}
    parts = [
        checks.check_unique(df, "asin").select(F.lit(zone).alias("zone"), "asin", "n_records")
        for zone, df in found.items()
    ]
    return parts[0].unionByName(parts[1])


@query
def check_unique_review_sk(spark, d):
    return checks.check_unique(s_fact(spark, d), "review_sk")


@query
def check_unique_product_id(spark, d):
    return checks.check_unique(twice(s_products(spark, d), "brand IS NULL"), "product_id")


@query
def check_unique_reviewer_id(spark, d):
    return checks.check_unique(twice(s_reviewers(spark, d), "reviewer_name IS NULL"), "reviewer_id")


@query
def check_unique_date_id(spark, d):
    return checks.check_unique(twice(s_dates(spark, d), "is_weekend"), "date_id")


@query
def check_accepted_month(spark, d):
    """Last days of long months carry month + 12."""
    odd = s_dates(spark, d).withColumn("month", F.expr("IF(day = 31, month + 12, month)"))
    return checks.check_accepted_values(odd, "month", suite.MONTHS)


@query
def check_accepted_rating(spark, d):
    """Ratings of reviews with impossible votes are half a star off."""
    odd = s_fact(spark, d).withColumn(
        "rating", F.expr("IF(helpful_votes > total_votes, rating + 0.5, rating)")
    )
    return checks.check_accepted_values(odd, "rating", suite.RATINGS)


@query
def check_price_range(spark, d):
    outside = checks.check_between(s_products(spark, d), "price_usd", *suite.PRICE_RANGE)
    return outside.select("product_id", "price_usd")


@query
def check_review_text_length(spark, d):
    outside = checks.check_length_between(s_fact(spark, d), "review_text", *suite.TEXT_LENGTH)
    return outside.select("review_sk", "review_text")


@query
def check_helpful_votes(spark, d):
    return checks.check_helpful_votes(s_fact(spark, d))


@query
def check_no_future_reviews(spark, d):
    return checks.check_no_future_reviews(s_fact(spark, d), AS_OF)


@query
def check_summary(spark, d):
    return suite.check_summary(s_tables(spark, d), AS_OF)


# --- whole tables -----------------------------------------------------------------------


@query
def dim_date(spark, d):
    return unstamped(s_dates(spark, d))


@query
def dim_products(spark, d):
    return unstamped(s_products(spark, d))


@query
def fct_review(spark, d):
    return s_fact(spark, d)


@query
def gold_category_ratings_monthly(spark, d):
    return gold.category_ratings_monthly(s_fact(spark, d), s_products(spark, d), s_dates(spark, d))


@query
def gold_brand_repeated_reviewers(spark, d):
    return gold.brand_repeated_reviewers(s_fact(spark, d), s_products(spark, d))


@query
def gold_reviews_per_reviewer(spark, d):
    return gold.reviews_per_reviewer(s_fact(spark, d))


@query
def gold_seasonality_and_reviews(spark, d):
    return gold.seasonality_and_reviews(s_fact(spark, d), s_dates(spark, d))


@query
def gold_weekend_review_behavior(spark, d):
    return gold.weekend_review_behavior(s_fact(spark, d), s_dates(spark, d))


# The survey's names for the two tables whose builders already bear them here.
_REGISTRY["bronze_products"] = _REGISTRY.pop("bronze_products_table")
_REGISTRY["bronze_reviews"] = _REGISTRY.pop("bronze_reviews_table")
