"""The check suite over landing and silver tables, its summary and its gate."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.operators.checks import (
    check_relationship,
    check_unique,
    more_helpful_than_total,
    outside_range,
    outside_values,
)

ERROR, WARN = "error", "warn"

MONTHS = list(range(1, 13))
RATINGS = [1.0, 2.0, 3.0, 4.0, 5.0]
PRICE_RANGE = (0, 10000)
TEXT_LENGTH = (1, 50000)


class CheckFailed(RuntimeError):
    """A check of severity error found something."""


@dataclass
class Tables:
    """The frames the suite runs on."""

    items: DataFrame
    metadata: DataFrame
    dates: DataFrame
    products: DataFrame
    reviewers: DataFrame
    fact: DataFrame


def _missing(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def _bad_values(column: str, accepted: list) -> Column:
    bad = F.when(outside_values(column, accepted), F.col(column))
    return F.count_distinct(bad)


def _melt(row: DataFrame, severities: dict[str, str]) -> DataFrame:
    """One row of counts to one row per check."""
    entries = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.lit(severity).alias("severity"),
            F.col(name).cast("bigint").alias("n_failed"),
        )
        for name, severity in severities.items()
    ]
    return row.select(F.inline(F.array(*entries)))


def _column_checks(df: DataFrame, checks: dict[str, tuple[str, Column]]) -> DataFrame:
    """All checks that look at one row at a time: one scan, one partial aggregate."""
    counts = df.agg(*[count.alias(name) for name, (_, count) in checks.items()])
    return _melt(counts, {name: severity for name, (severity, _) in checks.items()})


def _counted(failures: DataFrame, name: str, severity: str, count: Column) -> DataFrame:
    return failures.agg(F.coalesce(count, F.lit(0)).alias(name)).transform(
        lambda row: _melt(row, {name: severity})
    )


# Of this length and form, a key is shuffled as the bytes that its digits name.
_MD5 = "^[0-9a-f]{32}$"


def _digest(column: str) -> Column:
    """A hex digest as bytes, in half the space; distinct for distinct keys of any form."""
    # Longer than a digest, so that no other text is taken for one.
    other = F.concat(F.lit(b"\0" * 17), F.col(column).cast("binary"))
    return F.when(F.col(column).rlike(_MD5), F.unhex(column)).otherwise(other)


def _unique(df: DataFrame, name: str, column: str, severity: str = ERROR) -> DataFrame:
    return _counted(check_unique(df, column), name, severity, F.count(F.lit(1)))


def _relationship(
    child: DataFrame, name: str, column: str, parent: DataFrame
) -> DataFrame:
    orphans = check_relationship(child, column, parent, column)
    return _counted(orphans, name, ERROR, F.sum("n_records"))


NOT_NULL = {
    "dates": ("date_id", "year", "month", "year_month"),
    "products": ("product_id",),
    "reviewers": ("reviewer_id",),
    "fact": ("review_sk", "reviewer_id", "product_id", "date_id", "rating", "review_date"),
}


def _not_null(table: str) -> dict[str, tuple[str, Column]]:
    return {f"{table}_{c}_not_null": (ERROR, _missing(c)) for c in NOT_NULL[table]}


def not_null_summary(tables: Tables) -> DataFrame:
    """The not-null checks of the star schema alone."""
    parts = [_column_checks(getattr(tables, t), _not_null(t)) for t in NOT_NULL]
    return reduce(DataFrame.unionByName, parts)


# Columns of the source tables that must not be null, by where the tables lie.
LANDING = {"items": ("reviewerID", "asin"), "metadata": ("asin",)}
STAGING = {"staging_items": ("reviewerID",), "staging_metadata": ("asin",)}


def source_not_null_summary(
    items: DataFrame, metadata: DataFrame, columns: dict[str, tuple[str, ...]] = LANDING
) -> DataFrame:
    """The not-null checks of the landing (or ``STAGING``) tables."""
    parts = [
        _column_checks(df, {f"{name}_{c}_not_null": (ERROR, _missing(c)) for c in names})
        for df, (name, names) in zip((items, metadata), columns.items())
    ]
    return reduce(DataFrame.unionByName, parts)


def source_summary(
    items: DataFrame, metadata: DataFrame, columns: dict[str, tuple[str, ...]] = LANDING
) -> DataFrame:
    """All checks on the landing (or ``STAGING``) tables."""
    name = f"{list(columns)[1]}_asin_unique"
    return source_not_null_summary(items, metadata, columns).unionByName(
        _unique(metadata, name, "asin", WARN)
    )


def silver_summary(tables: Tables, as_of: dt.date) -> DataFrame:
    """Checks on the star schema."""
    t = tables
    price = outside_range(F.col("price_usd"), *PRICE_RANGE)
    length = outside_range(F.char_length("review_text"), *TEXT_LENGTH)
    parts = [
        _column_checks(
            t.dates,
            _not_null("dates")
            | {"dates_month_accepted": (ERROR, _bad_values("month", MONTHS))},
        ),
        _column_checks(
            t.products,
            _not_null("products") | {"products_price_usd_range": (WARN, F.count_if(price))},
        ),
        _column_checks(t.reviewers, _not_null("reviewers")),
        _column_checks(
            t.fact,
            _not_null("fact")
            | {
                "fact_rating_accepted": (ERROR, _bad_values("rating", RATINGS)),
                "fact_review_text_length": (WARN, F.count_if(length)),
                "fact_helpful_votes_valid": (WARN, F.count_if(more_helpful_than_total())),
                "fact_no_future_reviews": (
                    ERROR,
                    F.count_if(F.col("review_date") > F.lit(as_of)),
                ),
            },
        ),
        _unique(t.dates, "dates_date_id_unique", "date_id"),
        _unique(t.products, "products_product_id_unique", "product_id"),
        _unique(t.reviewers, "reviewers_reviewer_id_unique", "reviewer_id"),
        _unique(t.fact.select(_digest("review_sk").alias("key")), "fact_review_sk_unique", "key"),
        _relationship(t.fact, "fact_reviewer_id_relationship", "reviewer_id", t.reviewers),
        _relationship(t.fact, "fact_product_id_relationship", "product_id", t.products),
        _relationship(t.fact, "fact_date_id_relationship", "date_id", t.dates),
    ]
    return reduce(DataFrame.unionByName, parts)


def check_summary(tables: Tables, as_of: dt.date) -> DataFrame:
    """Every check with its severity and its number of failures."""
    return source_summary(tables.items, tables.metadata).unionByName(
        silver_summary(tables, as_of)
    )


def gate(summary: DataFrame) -> list[dict]:
    """Raise if a check of severity error failed; otherwise return all results.

    The summary has one row per check, so it is small enough for the driver.
    """
    results = [row.asDict() for row in summary.collect()]
    failed = [r for r in results if r["severity"] == ERROR and r["n_failed"] > 0]
    if failed:
        text = ", ".join(f"{r['check_name']} ({r['n_failed']})" for r in failed)
        raise CheckFailed(text)
    return results
