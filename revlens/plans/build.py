"""A whole run: landing tables to marts, with checks in between and an audit trail."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.plans import gold, silver
from revlens.plans.bronze import bronze_products, bronze_reviews
from revlens.plans.suite import Tables, gate, silver_summary, source_summary
from revlens.sinks.audit import append_run
from revlens.sinks.fact import FILE_ROWS, has_fact, merge_fact, read_fact, register_snapshot, write_fact
from revlens.sinks.tables import create_namespace, merge_table, read_table, register_table, write_table

# The versioned tables of a run, beside the fact.
TABLES = (
    "bronze_products",
    "bronze_reviews",
    "silver_dim_date",
    "silver_dim_products",
    "silver_dim_reviewer",
    "gold_category_ratings_monthly",
    "gold_brand_repeated_reviewers",
    "gold_reviews_per_reviewer",
    "gold_seasonality_and_reviews",
    "gold_weekend_review_behavior",
)


class Warehouse:
    """Tables below one folder, every write and check of a run on record."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.run_id: str | None = None

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(name))

    def fact(self) -> DataFrame:
        return read_fact(self.spark, self.path("silver_fct_review"))

    def register(self, namespace: str) -> None:
        """Make all tables known to the catalog under their names."""
        create_namespace(self.spark, namespace)
        for name in TABLES:
            register_table(self.spark, namespace, name, self.path(name))
        register_snapshot(self.spark, self.path("silver_fct_review"), namespace, "silver_fct_review")

    def record(self, job: str, action: Callable, *args):
        """Run one step and append its outcome to the audit table."""
        started = time.monotonic()
        outcome: dict = {"status": "success"}
        try:
            result = action(*args)
            if result is not None:
                outcome["result"] = result
            return result
        except Exception as failure:
            outcome |= {"status": "error", "error": str(failure)}
            raise
        finally:
            outcome["elapsed_seconds"] = time.monotonic() - started
            self.run_id = append_run(
                self.spark, self.path("audit_runs"), job, outcome, run_id=self.run_id
            )

    def rebuild(self, name: str, df: DataFrame) -> DataFrame:
        self.record(name, write_table, df, self.path(name))
        return self.table(name)

    def merge(self, name: str, df: DataFrame, key: str, updates: list[str]) -> DataFrame:
        self.record(name, merge_table, df, self.path(name), key, updates)
        return self.table(name)


def build(
    spark: SparkSession,
    landing_dir: str,
    warehouse_dir: str,
    as_of: dt.date,
    loaded_at: dt.datetime | None = None,
    namespace: str | None = None,
) -> Warehouse:
    """Build every table from ``landing_dir`` (tables ``metadata`` and ``items_dedup``).

    ``as_of`` stands for today: it sets the late-arrival window of an incremental
    run and the bound of the future check. An error-level check stops the run
    before the tables that depend on the checked ones. With a ``namespace`` the finished
    tables can be queried by name there.
    """
    wh = Warehouse(spark, warehouse_dir)
    stamp = F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp()
    metadata = read_table(spark, f"{landing_dir}/metadata")
    items = read_table(spark, f"{landing_dir}/items_dedup")
    wh.record("check_sources", lambda: gate(source_summary(items, metadata)))

    products_in = wh.rebuild("bronze_products", bronze_products(metadata, stamp))
    reviews_in = wh.rebuild("bronze_reviews", bronze_reviews(items, stamp))

    dates = wh.rebuild("silver_dim_date", silver.dim_date(reviews_in, stamp))
    products = wh.merge(
        "silver_dim_products",
        silver.dim_products(products_in, stamp),
        "product_id",
        silver.PRODUCT_UPDATES,
    )
    reviewers = wh.merge(
        "silver_dim_reviewer",
        silver.dim_reviewer(reviews_in, stamp),
        "reviewer_id",
        silver.REVIEWER_UPDATES,
    )
    fact_path = wh.path("silver_fct_review")
    if has_fact(spark, fact_path):
        recent = silver.fct_review(reviews_in, incremental_as_of=as_of)
        wh.record("silver_fct_review", merge_fact, recent, fact_path)
    else:
        wh.record("silver_fct_review", write_fact, silver.fct_review(reviews_in), fact_path, FILE_ROWS)
    fact = wh.fact()

    tables = Tables(items, metadata, dates, products, reviewers, fact)
    wh.record("check_silver", lambda: gate(silver_summary(tables, as_of)))

    wh.rebuild(
        "gold_category_ratings_monthly", gold.category_ratings_monthly(fact, products, dates)
    )
    wh.rebuild("gold_brand_repeated_reviewers", gold.brand_repeated_reviewers(fact, products))
    wh.rebuild("gold_reviews_per_reviewer", gold.reviews_per_reviewer(fact))
    wh.rebuild("gold_seasonality_and_reviews", gold.seasonality_and_reviews(fact, dates))
    wh.rebuild("gold_weekend_review_behavior", gold.weekend_review_behavior(fact, dates))
    if namespace:
        wh.record("register", wh.register, namespace)
    return wh
