import datetime as dt
import glob
import gzip
import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from revlens.plans.build import build
from revlens.plans.ingest import ingest_reviews
from revlens.plans.suite import CheckFailed
from revlens.schemas import PRODUCT_LANDING, REVIEW_LANDING
from revlens.session import scratch_path, shared_dir
from revlens.sinks import (
    append_run,
    create_namespace,
    merge_fact,
    merge_table,
    read_fact,
    read_runs,
    read_table,
    write_fact,
    write_table,
)
from revlens.sinks import fact as fact_sink
from revlens.sinks.tables import commit_version, rejected_records, stage_version
from revlens.sources import load_table
from revlens.streaming import merge_arrivals


def test_shared_dir_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_versions_publish_only_when_committed(frame, rows, spark, tmp_path):
    table = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        read_table(spark, table)
    write_table(frame("v int", (1,)), table)
    staged = stage_version(frame("v int", (2,)), table)
    assert rows(read_table(spark, table)) == [(1,)]
    commit_version(spark, table, staged)
    assert rows(read_table(spark, table)) == [(2,)]


def test_a_table_can_be_rewritten_from_itself(frame, rows, spark, tmp_path):
    table = str(tmp_path / "t")
    write_table(frame("v int", (1,)), table)
    for _ in range(11):
        write_table(read_table(spark, table).select((F.col("v") + 1).alias("v")), table)
    assert rows(read_table(spark, table)) == [(12,)]


def test_merge_table_creates_then_merges(frame, rows, spark, tmp_path):
    table, schema = str(tmp_path / "t"), "k string, a string, first int"
    merge_table(frame(schema, ("x", "one", 1)), table, "k", ["a"])
    merge_table(frame(schema, ("x", "two", 2), ("y", "new", 3)), table, "k", ["a"])
    assert rows(read_table(spark, table)) == [("x", "two", 1), ("y", "new", 3)]


def test_namespace(spark):
    create_namespace(spark, "reviews_test")
    create_namespace(spark, "reviews_test")
    assert spark.catalog.databaseExists("reviews_test")


FACT = (
    "review_sk string, reviewer_id string, product_id string, review_date date, rating double"
)


def fact_rows(*triples):
    return [(sk, "r", "p", dt.date.fromisoformat(day), rating) for sk, day, rating in triples]


def test_fact_merge_touches_only_its_months(frame, rows, spark, tmp_path):
    path = str(tmp_path / "f")
    old = fact_rows(("a", "2020-01-05", 1.0), ("b", "2020-02-05", 2.0), ("c", "2020-02-06", 3.0))
    write_fact(frame(FACT, *old), path)
    january = month_files(path, "2020-01-01")
    new = fact_rows(("b", "2020-02-05", 9.0), ("d", "2020-02-07", 4.0), ("e", "2020-03-01", 5.0))
    merge_fact(frame(FACT, *new), path)
    assert [(r[0], r[4]) for r in rows(read_fact(spark, path))] == [
        ("a", 1.0), ("b", 9.0), ("c", 3.0), ("d", 4.0), ("e", 5.0),
    ]
    assert month_files(path, "2020-01-01") == january
    # One write per touched month: February has one new folder, March its first.
    assert len(month_folders(path, "2020-02-01")) == 2 and len(month_folders(path, "2020-03-01")) == 1
    merge_fact(frame(FACT, *new), path)
    assert read_fact(spark, path).count() == 5
    merge_fact(frame(FACT), path)
    assert read_fact(spark, path).count() == 5


def month_folders(path, month):
    return sorted(glob.glob(f"{path}/data/version=*/review_month={month}"))


def month_files(path, month):
    files = [f for folder in month_folders(path, month) for f in glob.glob(f"{folder}/*/*.parquet")]
    return {f: os.stat(f).st_mtime for f in files}


def ratings(rows, df):
    return [(r[0], r[4]) for r in rows(df)]


BEFORE = [("a", 1.0), ("b", 2.0)]
AFTER = [("a", 1.0), ("b", 9.0), ("c", 3.0)]


@pytest.fixture
def stored_fact(frame, tmp_path):
    path = str(tmp_path / "f")
    write_fact(frame(FACT, *fact_rows(("a", "2020-01-05", 1.0), ("b", "2020-01-06", 2.0))), path)
    return path, frame(FACT, *fact_rows(("b", "2020-01-06", 9.0), ("c", "2020-02-01", 3.0)))


def test_readers_see_a_merge_whole_or_not_at_all(rows, spark, stored_fact, monkeypatch):
    path, incoming = stored_fact
    before = read_fact(spark, path)
    publish = fact_sink._publish

    def watched(*args):
        # All months are written by now, and none is visible.
        assert ratings(rows, read_fact(spark, path)) == BEFORE
        publish(*args)
        assert ratings(rows, read_fact(spark, path)) == AFTER

    monkeypatch.setattr(fact_sink, "_publish", watched)
    merge_fact(incoming, path)
    # A frame defined before the merge still has its files.
    assert ratings(rows, before) == BEFORE
    assert ratings(rows, read_fact(spark, path, snapshot=1)) == BEFORE


@pytest.mark.parametrize("step", ["merge_upsert", "_write_version", "_publish", "rename_new"])
def test_a_merge_lost_at_any_step_can_be_repeated(rows, spark, stored_fact, monkeypatch, step):
    path, incoming = stored_fact
    run = getattr(fact_sink, step)

    def lose(*args, **options):
        if step == "_write_version":
            run(*args, **options)
        raise PySparkException("lost")

    monkeypatch.setattr(fact_sink, step, lose)
    with pytest.raises(PySparkException, match="lost"):
        merge_fact(incoming, path)
    assert ratings(rows, read_fact(spark, path)) == BEFORE
    monkeypatch.setattr(fact_sink, step, run)
    merge_fact(incoming, path)
    assert ratings(rows, read_fact(spark, path)) == AFTER
    assert fact_sink.expire_snapshots(spark, path) >= 1
    assert ratings(rows, read_fact(spark, path)) == AFTER and fact_sink.snapshots(spark, path) == [2]
    assert len(month_folders(path, "2020-01-01")) == len(month_folders(path, "2020-02-01")) == 1


def test_two_writers_do_not_lose_rows(frame, rows, spark, stored_fact, monkeypatch):
    path, incoming = stored_fact
    publish = fact_sink._publish

    def overtaken(*args):
        monkeypatch.setattr(fact_sink, "_publish", publish)
        merge_fact(frame(FACT, *fact_rows(("d", "2020-01-07", 4.0))), path)
        publish(*args)

    monkeypatch.setattr(fact_sink, "_publish", overtaken)
    with pytest.raises(fact_sink.ConcurrentMerge):
        merge_fact(incoming, path)
    assert ratings(rows, read_fact(spark, path)) == [*BEFORE, ("d", 4.0)]


def test_tables_from_before_the_manifests_are_refused(frame, spark, tmp_path):
    path = str(tmp_path / "f")
    frame(FACT).write.parquet(path)
    with pytest.raises(RuntimeError, match="write_fact"):
        fact_sink.has_fact(spark, path)
    with pytest.raises(FileNotFoundError):
        read_fact(spark, path)


def test_an_empty_fact_can_be_read_and_merged(frame, rows, spark, tmp_path):
    path = str(tmp_path / "f")
    write_fact(frame(FACT), path)
    assert read_fact(spark, path).columns == frame(FACT).columns and read_fact(spark, path).count() == 0
    merge_fact(frame(FACT, *fact_rows(("a", "2020-01-05", 1.0))), path)
    assert ratings(rows, read_fact(spark, path)) == [("a", 1.0)]


def test_fact_reader_prunes_months(frame, spark, tmp_path):
    path = str(tmp_path / "f")
    write_fact(frame(FACT, *fact_rows(("a", "2020-01-05", 1.0), ("b", "2020-02-05", 2.0))), path)
    df = read_fact(spark, path, since=dt.date(2020, 2, 3))
    assert [r.review_sk for r in df.collect()] == ["b"]
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "review_month" in plan.split("PartitionFilters:")[1].split("\n")[0]


def test_fact_files_hold_one_month_in_key_order(spark, tmp_path):
    path = str(tmp_path / "f")
    fact = spark.range(0, 4000, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("review_sk"),
        (F.col("id") % 7).cast("string").alias("reviewer_id"),
        F.format_string("p%03d", F.col("id") * 31 % 100).alias("product_id"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 90).cast("int")).alias("review_date"),
    )
    write_fact(fact, path)
    for month in ("2020-01-01", "2020-02-01", "2020-03-01"):
        (file,) = month_files(path, month)
        keys = [tuple(r) for r in spark.read.parquet(file).select("product_id", "reviewer_id").collect()]
        assert keys == sorted(keys) and len(keys) > 1000


def test_files_of_a_month_hold_disjoint_products(spark, tmp_path, frame):
    """Written and merged months are cut into product ranges; a hot product is one of them."""
    path = str(tmp_path / "f")
    fact = spark.range(0, 6000, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("review_sk"),
        (F.col("id") % 7).cast("string").alias("reviewer_id"),
        F.when(F.col("id") % 3 == 0, F.lit("B00HOT")).otherwise(
            F.format_string("B%05d", F.col("id") * 31 % 977)
        ).alias("product_id"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 60).cast("int")).alias("review_date"),
    )
    write_fact(fact, path, file_rows=500)
    for day in ("2020-01-31", "2020-02-29"):
        extra = frame(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fact.schema),
                      ("new" + day, "r", "B00500", dt.date.fromisoformat(day)))
        before = len(month_folders(path, day[:8] + "01"))
        merge_fact(extra, path, file_rows=500)
        folder = month_folders(path, day[:8] + "01")[-1]
        assert len(month_folders(path, day[:8] + "01")) == before + 1
        bounds = []
        for file in glob.glob(f"{folder}/*/*.parquet"):
            statistics = pq.ParquetFile(file).metadata.row_group(0)
            (column,) = [
                statistics.column(i).statistics
                for i in range(statistics.num_columns)
                if statistics.column(i).path_in_schema == "product_id"
            ]
            bounds.append((column.min, column.max))
        bounds.sort()
        assert len(bounds) >= 4
        assert all(last < first for (_, last), (first, _) in zip(bounds, bounds[1:]))
    assert read_fact(spark, path).count() == 6002
    plan = spark._jvm.PythonSQLUtils.explainString(
        read_fact(spark, path).where("product_id = 'B00500'")._jdf.queryExecution(), "formatted"
    )
    assert "EqualTo(product_id,B00500)" in plan


def test_copies_of_one_review_split_over_tasks(spark, tmp_path, conf):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB")
    path = str(tmp_path / "f")
    copies = spark.range(0, 40000, 1, 8).select(
        F.lit("k").alias("review_sk"),
        F.lit("r").alias("reviewer_id"),
        F.lit("p").alias("product_id"),
        F.lit(dt.date(2020, 1, 1)).alias("review_date"),
        F.col("id").alias("rating"),
    )
    write_fact(copies, path)
    sizes = [r["count"] for r in read_fact(spark, path).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 40000 and max(sizes) < 20000


def test_audit(spark, tmp_path):
    log = str(tmp_path / "audit")
    run = append_run(spark, log, "load", {"bad_records": 2, "elapsed_seconds": 1.5}, rows=7)
    append_run(spark, log, "clean", {"status": "error", "parse_errors": 3}, run_id=run)
    got = {r.job: r for r in read_runs(spark, log).collect()}
    assert (got["load"].status, got["load"].rows, got["load"].bad_records) == ("success", 7, 2)
    assert (got["clean"].status, got["clean"].bad_records) == ("error", 3)
    assert got["load"].run_id == got["clean"].run_id == run
    assert json.loads(got["clean"].details)["parse_errors"] == 3


# --- whole runs

DAY = 86400
START = (dt.date(2020, 1, 1) - dt.date(1970, 1, 1)).days * DAY


def landing(spark, path, products, reviews):
    for name, records, schema in (
        ("metadata", products, PRODUCT_LANDING),
        ("items_dedup", reviews, REVIEW_LANDING),
    ):
        source = f"{path}-{name}-ndjson"
        lines = [(json.dumps(r),) for r in records]
        spark.createDataFrame(lines, "value string").write.mode("overwrite").text(source)
        load_table(spark, source, f"{path}/{name}", schema)


def product(asin, **more):
    return {"asin": asin, "title": f"t{asin}", "brand": "B", "price": 5, "imUrl": f"u{asin}",
            "categories": [["C"]]} | more


def review(reviewer, asin, day, **more):
    return {"reviewerID": reviewer, "asin": asin, "reviewerName": reviewer.upper(), "overall": 4.0,
            "helpful": [1, 2], "reviewText": "x", "summary": "s",
            "unixReviewTime": START + day * DAY} | more


@pytest.fixture
def site(spark, tmp_path):
    return str(tmp_path / "landing"), str(tmp_path / "warehouse")


def test_build_twice(spark, site):
    source, target = site
    reviews = [review(f"r{i}", "1", i % 40) for i in range(12)]
    landing(spark, source, [product("1")], reviews)
    wh = build(spark, source, target, dt.date(2020, 2, 10), dt.datetime(2020, 2, 10))
    assert wh.fact().count() == 12
    brand = wh.table("gold_brand_repeated_reviewers").first()
    assert (brand.brand, brand.total_reviews, brand.brand_rank) == ("B", 12, 1)

    # A day later: changed product, one recent new review, one that arrives too late.
    late = [review("late", "1", 1), review("new", "1", 41, reviewerName="N")]
    landing(spark, source, [product("1", title="renamed", imUrl="moved")], reviews + late)
    wh = build(spark, source, target, dt.date(2020, 2, 13), dt.datetime(2020, 2, 13))
    assert {r.reviewer_id for r in wh.fact().collect()} == {f"r{i}" for i in range(12)} | {"new"}
    row = wh.table("silver_dim_products").first()
    assert (row.product_name, row.image_url) == ("renamed", "u1")
    assert wh.table("silver_dim_reviewer").count() == 14
    runs = read_runs(spark, f"{target}/audit_runs")
    assert runs.where("status <> 'success'").count() == 0
    assert runs.groupBy("run_id").count().count() == 2


def test_build_stops_before_gold_on_an_error(spark, site):
    source, target = site
    landing(spark, source, [product("1")], [review("r", "missing", 0)])
    with pytest.raises(CheckFailed, match="fact_product_id_relationship"):
        build(spark, source, target, dt.date(2020, 2, 10))
    assert not os.path.exists(f"{target}/gold_reviews_per_reviewer")
    failed = read_runs(spark, f"{target}/audit_runs").where("status = 'error'").collect()
    assert [r.job for r in failed] == ["check_silver"]


def test_stream_takes_each_file_once(spark, tmp_path):
    arrivals, fact, offsets = (str(tmp_path / n) for n in ("in", "fact", "offsets"))
    today = dt.date(2020, 2, 10)

    def deliver(*records):
        lines = [(json.dumps(r),) for r in records] + [("not a record",)]
        spark.createDataFrame(lines, "value string").write.mode("append").text(arrivals)

    deliver(review("a", "1", 0), review("a", "1", 0), review("b", "1", 38))
    merge_arrivals(spark, arrivals, fact, offsets, today)
    assert read_fact(spark, fact).count() == 2
    deliver(review("b", "1", 38, overall=1.0), review("c", "1", 39), review("late", "1", 1))
    merge_arrivals(spark, arrivals, fact, offsets, today)
    got = {r.reviewer_id: r.rating for r in read_fact(spark, fact).collect()}
    assert got == {"a": 4.0, "b": 1.0, "c": 4.0}
    merge_arrivals(spark, arrivals, fact, offsets, today)
    assert read_fact(spark, fact).count() == 3


def test_a_batch_over_budget_is_set_aside(spark, tmp_path):
    arrivals, fact, offsets = (str(tmp_path / n) for n in ("in", "fact", "offsets"))
    today = dt.date(2020, 2, 10)

    def deliver(*lines):
        spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(arrivals)

    for lines in (
        [json.dumps(review("a", "1", 38)), "bad"],
        [json.dumps(review("b", "1", 39)), *["bad"] * 11],
        [json.dumps(review("c", "1", 40))],
    ):
        deliver(*lines)
        audit = merge_arrivals(spark, arrivals, fact, offsets, today)
    assert {r.reviewer_id for r in read_fact(spark, fact).collect()} == {"a", "c"}
    runs = {r.job: r for r in audit.collect()}
    assert [runs[f"batch-{i}"].status for i in range(3)] == ["success", "quarantined", "success"]
    assert runs["batch-0"].bad_records == 1
    kept = json.loads(runs["batch-1"].details)["table"]
    rows = spark.read.parquet(f"{kept}/v00000001")
    assert rows.where("is_bad = 'true'").count() == 11
    assert rows.where("is_bad = 'false'").first().reviewerID == "b"


def test_jobs_from_gzip_files_to_marts(spark, tmp_path):
    from revlens.__main__ import main

    def gz(name, lines):
        path = tmp_path / name
        path.write_bytes(gzip.compress("\n".join(lines).encode()))
        return str(path)

    products = gz("p.gz", ["[", "{'asin': '1', 'title': \"it's\", 'brand': 'B', 'price': 3.5},",
                           json.dumps(product("2")), "{'asin': None}", "oops", "]"])
    reviews = gz("r.gz", [json.dumps(review(f"r{i}", "12"[i % 2], i)) for i in range(24)])
    source, target = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    main(["ingest", products, reviews, source, "--partitions", "3"])
    runs = {r.job: r for r in read_runs(spark, f"{source}/audit_runs").collect()}
    assert (runs["ingest_products"].rows, runs["ingest_products"].bad_records) == (2, 1)
    assert json.loads(runs["ingest_products"].details)["parse_errors"] == 1
    assert runs["ingest_reviews"].rows == 24 and runs["ingest_reviews"].input_bytes == os.path.getsize(reviews)
    assert json.loads(runs["ingest_products"].reasons) == {"no_record": 1, "missing:asin": 1}
    rejected = rejected_records(spark, f"{source}/metadata").orderBy("row").collect()
    assert [(r["line"], r["reason"]) for r in rejected] == [('{"asin": null}', "missing:asin"), ("oops", "no_record")]
    main(["build", source, target, "--as-of", "2020-02-10", "--namespace", "reviews_run"])
    by_name = spark.sql("SELECT product_id, count(*) AS n FROM reviews_run.silver_fct_review GROUP BY product_id")
    assert {tuple(r) for r in by_name.collect()} == {("1", 12), ("2", 12)}
    assert spark.table("reviews_run.gold_brand_repeated_reviewers").first().brand == "B"
    assert spark.table("reviews_run.silver_dim_products").count() == 2
    assert read_fact(spark, f"{target}/silver_fct_review").count() == 24
    marts = read_table(spark, f"{target}/gold_brand_repeated_reviewers").collect()
    assert [(r.brand, r.total_reviews, r.unique_reviewers) for r in marts] == [("B", 24, 24)]


def test_inferred_reviews(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(json.dumps(review("a", "1", 0)),)], "value string").write.text(source)
    ingest_reviews(spark, source, str(tmp_path / "landing"), schema=None)
    row = read_table(spark, str(tmp_path / "landing/items_dedup")).first()
    assert (row.reviewerID, row.helpful, row.overall) == ("a", [1, 2], 4.0)
