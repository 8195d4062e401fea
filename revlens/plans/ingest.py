"""Raw line files to landing tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revlens.schemas import PRODUCT_LANDING, REVIEW_LANDING
from revlens.sinks.audit import append_run
from revlens.sources.landing import load_lines, load_table
from revlens.sources.lines import POSITION, input_bytes, normalize_lines, read_positioned, require_utf8
from revlens.sources.records import clean_records


def ingest_products(
    spark: SparkSession, source: str, landing_dir: str, partitions: int | None = None
) -> dict:
    """Loose product lines to the ``metadata`` table, cleaned and loaded in one pass.

    Lines that are no record are set aside and counted; records that do not fit the
    table count against the budget of the load. ``rejected_records`` has both.
    """
    lines = normalize_lines(require_utf8(read_positioned(spark, source, partitions)))
    records = clean_records(lines).select(
        F.coalesce("record", "value").alias("value"), *POSITION, F.col("record").isNull().alias("no_record")
    )
    result = load_lines(records, f"{landing_dir}/metadata", PRODUCT_LANDING, tolerated="no_record")
    return result | {"input_bytes": input_bytes(spark, source)}


def ingest_reviews(
    spark: SparkSession,
    source: str,
    landing_dir: str,
    partitions: int | None = None,
    schema: StructType | None = REVIEW_LANDING,
) -> dict:
    """Review lines to the ``items_dedup`` table; ``schema=None`` infers the types."""
    return load_table(
        spark, source, f"{landing_dir}/items_dedup", schema, partitions=partitions
    )


def ingest(
    spark: SparkSession,
    products_path: str,
    reviews_path: str,
    landing_dir: str,
    partitions: int | None = None,
) -> None:
    """Both landing tables, each load on record in ``<landing_dir>/audit_runs``."""
    run_id = None
    for job, load, path in (
        ("ingest_products", ingest_products, products_path),
        ("ingest_reviews", ingest_reviews, reviews_path),
    ):
        result = load(spark, path, landing_dir, partitions)
        run_id = append_run(
            spark, f"{landing_dir}/audit_runs", job, result, result["rows_loaded"], run_id
        )
