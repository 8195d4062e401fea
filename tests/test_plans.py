import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from revlens.plans import gold, silver
from revlens.plans.bronze import bronze_products, bronze_reviews
from revlens.plans.suite import CheckFailed, Tables, check_summary, gate
from revlens.schemas import PRODUCT_LANDING, REVIEW_LANDING

DAY = 86400


@pytest.fixture
def products(spark):
    def make(*rows):
        """Landing products from dictionaries, through bronze."""
        fields = PRODUCT_LANDING.fieldNames()
        data = [tuple(r.get(f) for f in fields) for r in rows]
        return bronze_products(spark.createDataFrame(data, PRODUCT_LANDING))

    return make


@pytest.fixture
def reviews(spark):
    def make(*rows):
        fields = REVIEW_LANDING.fieldNames()
        data = [tuple(r.get(f) for f in fields) for r in rows]
        return bronze_reviews(spark.createDataFrame(data, REVIEW_LANDING))

    return make


def review(reviewer="r", product="p", time=0, **more):
    return {"reviewerID": reviewer, "asin": product, "unixReviewTime": time, **more}


def test_bronze_columns(products, reviews):
    stamp = F.lit(dt.datetime(2020, 1, 1)).alias("x")
    assert products({"asin": "1", "price": "3.17"}).columns == [
        "product_id", "product_name", "product_description", "brand", "price_usd", "image_url",
        "categories_json", "sales_rank_json", "related_products_json", "_loaded_at",
    ]
    assert reviews(review()).columns == [
        "reviewer_id", "product_id", "reviewer_name", "reviewer_text", "review_summary", "rating",
        "helpful_array", "unix_review_time", "review_time_raw", "_loaded_at",
    ]
    landing = products({"asin": "1"}).select(F.col("product_id").alias("asin"))
    for name in PRODUCT_LANDING.fieldNames()[1:]:
        landing = landing.withColumn(name, F.lit(None).cast("string"))
    stamped = bronze_products(landing, stamp).first()
    assert stamped["_loaded_at"] == dt.datetime(2020, 1, 1)


def test_bad_price_fails_bronze(products):
    with pytest.raises(PySparkException, match="not a number"):
        products({"asin": "1", "price": "abc"}).collect()


@pytest.mark.parametrize(
    ("price", "kept"), [("-1", False), ("0", True), (None, True), ("NaN", False), ("3.5", True)]
)
def test_negative_price(products, price, kept):
    df = silver.without_negative_price(products({"asin": "1", "price": price}))
    assert (df.count() == 1) is kept


FULL = {
    "asin": "1",
    "title": "full",
    "description": "d",
    "price": "1",
    "brand": "b",
    "imUrl": "u",
    "categories": '[["A"]]',
}
ORDER = ["categories", "description", "brand", "price", "imUrl"]


@pytest.mark.parametrize("index", range(5))
def test_dedup_flags_decide_in_order(products, index):
    # The winner lacks everything after the deciding column, the loser only that column.
    winner = FULL | {"title": "winner"} | dict.fromkeys(ORDER[index + 1 :])
    loser = FULL | {"title": "a", ORDER[index]: None}
    kept = silver.dedup_products(products(loser, winner)).collect()
    assert [r.product_name for r in kept] == ["winner"]


def test_dedup_full_tie_is_deterministic(products):
    for rows in ([FULL, FULL | {"title": "a"}], [FULL | {"title": "a"}, FULL]):
        assert [r.product_name for r in silver.dedup_products(products(*rows)).collect()] == ["a"]


def test_dim_products(products):
    rows = silver.dim_products(products(FULL, {"asin": "2", "categories": "[]"})).orderBy("product_id")
    first, second = rows.collect()
    assert (first.primary_category, first.detailed_categorization) == ("A", '[["A"]]')
    assert (second.primary_category, second.detailed_categorization) == (None, "[]")


def test_dim_date(reviews):
    friday = 1 * DAY  # 1970-01-02
    rows = silver.dim_date(reviews(review(time=friday + 86399), review(time=4 * DAY), review(time=None)))
    got = [(r.date_id, r.day_of_week, r.is_weekend) for r in rows.orderBy("date_id").collect()]
    assert got == [(19700102, 6, False), (19700103, 7, True), (19700104, 1, True), (19700105, 2, False)]
    assert dict(rows.dtypes)["year_month"] == "date" and rows.first().year_month == dt.date(1970, 1, 1)


def test_dim_date_without_times(reviews):
    df = reviews(review(time=None))
    assert silver.date_bounds(df).collect() == [(None, None)]
    assert silver.dim_date(df).count() == 0


def test_impossible_time_fails(reviews):
    with pytest.raises(PySparkException, match="outside the years"):
        silver.dim_date(reviews(review(time=10**13))).collect()


def test_fact_columns_and_filters(reviews):
    full = review(time=1370000000, helpful=[2, 3], overall=4.0, reviewText="t", summary="s")
    df = silver.fct_review(
        reviews(full, review(reviewer=None), review(product=None), review(time=None))
    )
    row = df.collect()[0].asDict()
    assert df.count() == 1
    assert row.pop("review_sk") and row == {
        "reviewer_id": "r", "product_id": "p", "date_id": 20130531,
        "review_date": dt.date(2013, 5, 31), "rating": 4.0, "helpful_votes": 2, "total_votes": 3,
        "review_summary": "s", "review_text": "t",
        "review_timestamp": dt.datetime(2013, 5, 31, 11, 33, 20),
    }


def test_lookback_boundary(reviews):
    as_of = dt.date(2020, 1, 10)
    first = (dt.date(2020, 1, 7) - dt.date(1970, 1, 1)).days * DAY
    df = reviews(review("in", time=first), review("out", time=first - 1))
    assert [r.reviewer_id for r in silver.fct_review(df, as_of).collect()] == ["in"]


def test_lookback_is_pushed_to_the_scan(spark, reviews, tmp_path):
    reviews(review()).write.parquet(str(tmp_path / "b"))
    df = silver.fct_review(spark.read.parquet(str(tmp_path / "b")), dt.date(2020, 1, 10))
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(unix_review_time,1578355200)" in plan
    assert "IsNotNull(reviewer_id)" in plan


@pytest.fixture
def star(spark):
    """Fact, products and dates from compact tuples."""

    def make(reviews, products=(), first=0):
        fact = spark.createDataFrame(
            [(f"{i}", r, p, d, v, h) for i, (r, p, d, v, h) in enumerate(reviews)],
            "review_sk string, reviewer_id string, product_id string, day int, rating double, helpful_votes bigint",
        ).withColumn("unix", F.col("day").cast("bigint") * DAY)
        from revlens.functions import calendar_date, date_key

        fact = fact.withColumn("date_id", date_key(calendar_date(F.col("unix")))).drop("day", "unix")
        dims = spark.createDataFrame(
            list(products), "product_id string, brand string, primary_category string"
        )
        times = spark.createDataFrame([(d * DAY,) for _, _, d, _, _ in reviews], "unix_review_time bigint")
        return fact, dims, silver.dim_date(times)

    return make


def test_bucket_bounds(frame):
    counts = [1, 2, 5, 6, 10, 11, 20, 21, 50, 51, 100, 101, 500, 501, 0]
    df = frame("n bigint", *[(c,) for c in counts]).select(
        gold.review_bucket_label(F.col("n")), gold.review_bucket_order(F.col("n"))
    )
    labels = [
        "1 review", "2-5 reviews", "6-10 reviews", "11-20 reviews", "21-50 reviews",
        "51-100 reviews", "101-500 reviews", "500+ reviews",
    ]
    orders = [1, 2, 2, 3, 3, 4, 4, 5, 5, 6, 6, 7, 7, 8, 8]
    assert [tuple(r) for r in df.collect()] == [(labels[o - 1], o) for o in orders]


def test_brand_mart(star):
    def brand(name, reviewers, reviews):
        return [(f"{name}{i % reviewers}", name, 0, 1.0, 0) for i in range(reviews)]

    plan = {"ten": (10, 20), "nine": (9, 99), "tie": (10, 20), "low": (200, 201), "tab": (10, 10)}
    rows = [r for name, (n, k) in plan.items() for r in brand(name, n, k)]
    names = {"tab": "\t"}
    dims = [(n, names.get(n, n), None) for n in plan] + [("x", "ten ", None)]
    fact, products, _ = star(rows, dims)
    got = {r.brand: tuple(r)[1:] for r in gold.brand_repeated_reviewers(fact, products).collect()}
    assert got == {
        "ten": (20, 10, 2.0, 1),
        "tie": (20, 10, 2.0, 1),
        "low": (201, 200, 1.0, 3),
    }


def test_untrimmed_brands_stay_apart(star):
    fact, products, _ = star(
        [("r", "a", 0, 1.0, 0), ("r", "b", 0, 1.0, 0)], [("a", "X", None), ("b", "X ", None)]
    )
    assert {r.brand for r in gold.brand_review_counts(fact, products).collect()} == {"X", "X "}


def test_top_categories(star):
    # Six categories with one reviewed product each, one with two, one without reviews, a null.
    dims = [(c, None, c) for c in "bcdefg"] + [("a1", None, "a"), ("a2", None, "a")]
    rows = [("r", p, 0, 1.0, 0) for p, _, _ in dims for _ in range(3 if p == "g" else 1)]
    fact, products, _ = star(rows + [("r", "n", 0, 1.0, 0)], dims + [("n", None, None), ("z", None, "z")])
    got = [tuple(r) for r in gold.top_categories(fact, products).collect()]
    assert got == [("a", 2), ("b", 1), ("c", 1), ("d", 1), ("e", 1)]


def test_category_ratings(star):
    fact, products, dates = star(
        [("r", "p", 0, 5.0, 0), ("s", "p", 30, 2.0, 0), ("t", "q", 31, 3.0, 0), ("u", "p", 31, None, 0),
         ("v", "gone", 0, 1.0, 0)],
        [("p", None, "P"), ("q", None, "P")],
    )
    got = {tuple(r) for r in gold.category_ratings_monthly(fact, products, dates).collect()}
    assert got == {(dt.date(1970, 1, 1), "P", 3.5), (dt.date(1970, 2, 1), "P", 3.0)}


def test_seasonality_averages_are_not_weighted(star):
    rows = [("r", "p", 0, 1.0, 4)] + [("r", "p", 365, 1.0, 1)] * 3 + [("r", "p", 366, 1.0, None)]
    fact, _, dates = star(rows + [("r", "p", 31, 1.0, None)])
    got = {r.month: tuple(r)[1:] for r in gold.seasonality_and_reviews(fact, dates).collect()}
    assert got == {1: ("January", 5, 2.5, 2.5), 2: ("February", 1, 1.0, None)}


def test_weekend_counts_only_days_with_reviews(star):
    fact, _, dates = star([("r", "p", d, 1.0, 0) for d in (1, 1, 2, 9, 9, 12)])
    got = {tuple(r) for r in gold.weekend_review_behavior(fact, dates).collect()}
    assert got == {("Weekday", 3, 2, 1.5), ("Weekend", 3, 2, 1.5)}


def test_reviews_per_reviewer(star):
    fact, _, _ = star([("a", "p", 0, 1.0, 0)] * 2 + [("b", "p", 0, 1.0, 0)])
    got = {tuple(r) for r in gold.reviews_per_reviewer(fact).collect()}
    assert got == {("a", 2, "2-5 reviews", 2), ("b", 1, "1 review", 1)}


def test_reading_order(star, frame):
    fact, _, dates = star([("r", "p", d, 1.0, 0) for d in (1, 2, 40, 400)])
    months = gold.in_reading_order(gold.seasonality_and_reviews(fact, dates), "seasonality_and_reviews")
    assert [r.month for r in months.collect()] == [1, 2]
    days = gold.in_reading_order(gold.weekend_review_behavior(fact, dates), "weekend_review_behavior")
    assert [r.day_type for r in days.collect()] == ["Weekend", "Weekday"]
    brands = frame("brand string, avg_reviews_per_reviewer double", ("a", 1.0), ("b", 3.0), ("c", 2.0))
    ordered = gold.in_reading_order(brands, "brand_repeated_reviewers").collect()
    assert [r.brand for r in ordered] == ["b", "c", "a"]


def suite_tables(spark, products, reviews, **fact_changes):
    items = reviews(review("r", "1", DAY, overall=3.0, reviewText="x", helpful=[1, 2]))
    meta = products(FULL)
    fact = silver.fct_review(items)
    for name, value in fact_changes.items():
        fact = fact.withColumn(name, value)
    landing_items = items.select(
        F.col("reviewer_id").alias("reviewerID"), F.col("product_id").alias("asin")
    )
    return Tables(
        landing_items,
        meta.select(F.col("product_id").alias("asin")),
        silver.dim_date(items),
        silver.dim_products(meta),
        silver.dim_reviewer(items),
        fact,
    )


def test_suite_passes_on_good_tables(spark, products, reviews):
    tables = suite_tables(spark, products, reviews)
    results = gate(check_summary(tables, dt.date(2020, 1, 1)))
    assert len(results) == 29 and all(r["n_failed"] == 0 for r in results)
    assert sum(r["severity"] == "warn" for r in results) == 4


def test_gate_warns_or_stops(spark, products, reviews):
    today = dt.date(2020, 1, 1)
    warned = suite_tables(spark, products, reviews, helpful_votes=F.lit(9).cast("bigint"))
    failed = {r["check_name"] for r in gate(check_summary(warned, today)) if r["n_failed"]}
    assert failed == {"fact_helpful_votes_valid"}
    broken = suite_tables(
        spark, products, reviews, rating=F.lit(7.0), product_id=F.lit("none"), review_text=F.lit("")
    )
    with pytest.raises(CheckFailed) as error:
        gate(check_summary(broken, today))
    assert "fact_rating_accepted (1)" in str(error.value)
    assert "fact_product_id_relationship (1)" in str(error.value)
    assert "review_text" not in str(error.value)
    with pytest.raises(CheckFailed, match="no_future"):
        gate(check_summary(suite_tables(spark, products, reviews), dt.date(1970, 1, 1)))
