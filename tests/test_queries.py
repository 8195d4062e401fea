"""Registered queries on tables of a few rows."""

import datetime as dt
import glob
import os

import pytest
from pyspark.errors import PySparkException

from revlens.operators.dedup import keep_first
from revlens.operators.merge import merge_upsert
from revlens.plans import silver
from revlens.session import shared_dir
from workload import queries


@pytest.fixture
def tables(spark, tmp_path):
    """A data folder of ``n`` orders, each with one line item, by ``n`` customers; returns its path."""

    def make(n, day=dt.datetime(1995, 3, 17)):
        frames = {
            "customer": ([(i, f"c{i}") for i in range(1, n + 1)], "c_custkey long, c_name string"),
            "orders": (
                [(i, i, day) for i in range(1, n + 1)],
                "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
            ),
            "lineitem": (
                [(i, 1, 1, 3.0, "A", "F") for i in range(1, n + 1)],
                "l_orderkey long, l_partkey long, l_linenumber long, l_quantity double, "
                "l_returnflag string, l_linestatus string",
            ),
            "part": (
                [(1, "name", "B", "T", 5, 10.5), (2, "other", "C", "T", 5, 10.5)],
                "p_partkey long, p_name string, p_brand string, p_type string, p_size long, p_retailprice double",
            ),
        }
        for name, (rows, schema) in frames.items():
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{n}/{name}.parquet")
        return f"{tmp_path}/{n}"

    return make


def test_having_min_reviewers_counts_all_reviews(spark, tables):
    """Neither the day of the month nor the rating decides which reviews count."""
    found = queries.having_min_reviewers(spark, tables(12)).collect()
    assert [tuple(r) for r in found] == [("B", 12, 12, 1.0)]
    assert queries.having_min_reviewers(spark, tables(9)).collect() == []


def test_arrivals_are_compressed_and_merge_whole(spark, tables):
    found = queries.stream_merge_arrivals(spark, tables(7))
    assert found.count() == 7 and found.columns == queries.s_fact(spark, tables(8)).columns
    folders = glob.glob(f"{shared_dir(spark)}/revlens/arrivals-*")
    files = [f for d in folders for f in os.listdir(d) if f.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)


def test_the_stored_fact_is_the_unique_fact(spark, tables, rows):
    """Rows are shuffled narrow: their key's text and dates are made when they are written."""
    path = tables(9, dt.datetime(2001, 6, 30))
    late = queries.fct_partitioned_merge(spark, path)
    assert rows(late) == rows(queries.merge_fct_review(spark, path).select(late.columns))
    narrow = silver.unique_reviews(queries.b_reviews(spark, path))
    assert {"review_sk", "date_id", "review_timestamp"}.isdisjoint(narrow.columns)
    assert rows(narrow.select(*silver.fact_columns())) == rows(queries.s_fact(spark, path))


def test_unique_fact_takes_the_same_copy_as_before(spark, rows):
    columns = (
        "reviewer_id string, product_id string, unix_review_time bigint, rating double, "
        "helpful_array array<bigint>, review_summary string, reviewer_text string"
    )
    given = [
        ("a-1", "2", 86400, 2.0, [1, 2], "s", None),
        ("a", "1-2", 86400, 1.0, None, "s", "t"),
        ("b", "1", 5, None, [1], None, "t"),
        ("b", "1", 5, 3.0, [], None, "t"),
        ("b", "1", 5, 3.0, [0, 9], None, "u"),
        ("b", "1", 6, 3.0, [0, 9], None, "u"),
    ]
    reviews = spark.createDataFrame(given, columns)
    fact = silver.fct_review(reviews)
    order = [fact[c].asc_nulls_last() for c in fact.columns if c != "review_sk"]
    expected = keep_first(fact, "review_sk", *order)
    assert rows(silver.unique_fct_review(reviews)) == rows(expected) and expected.count() == 3


def test_merge_shuffles_only_what_can_match(spark, frame, rows):
    schema = "k string, day int, v int"
    target = frame(schema, ("a", 1, 1), ("b", 2, 1), ("c", 3, 1), (None, 3, 1), ("d", None, 1))
    source = frame(schema, ("c", 3, 2), ("e", 4, 2), (None, 4, 2))
    within = target["day"] >= 3
    merged = merge_upsert(target, source, "k", within=within)
    assert rows(merged) == rows(merge_upsert(target, source, "k"))
    double = frame(schema, ("c", 3, 2), ("c", 3, 4))
    with pytest.raises(PySparkException):
        merge_upsert(target, double, "k", within=within).collect()
