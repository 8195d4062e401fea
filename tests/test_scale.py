"""Plans on stored tables, and models on data where a third of all rows share a key."""

import datetime as dt
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from revlens.plans import gold, silver, suite
from revlens.sinks import read_fact, read_table, write_fact, write_table

DAY = 86400
N = 6000


def raw_reviews():
    """A third of the reviews are one product, a third of all rows one reviewer."""
    rows = []
    for i in range(N):
        product = "hot" if i % 3 == 0 else f"p{i % 97}"
        reviewer = "busy" if i % 3 == 1 else f"r{i % 211}"
        name = None if i % 5 == 0 else f"n{i % 4}"
        rows.append((reviewer, product, name, "t", "s", float(1 + i % 5), [i % 3, i % 4], i * 7919 % 800 * DAY + i))
    return rows


def raw_products():
    rows = [("hot", f"copy {i}", "H" if i % 2 else None, 1.0, None, None, None) for i in range(500)]
    rows.append(("hot", "best", "H", 1.0, "d", "u", '[["C0"]]'))
    return rows + [(f"p{i}", "x", f"B{i % 3}", 1.0, "d", "u", f'[["C{i % 7}"]]') for i in range(97)]


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """The silver tables on disk, built from the skewed rows."""
    root = str(tmp_path_factory.mktemp("star"))
    reviews = spark.createDataFrame(
        raw_reviews(),
        "reviewer_id string, product_id string, reviewer_name string, reviewer_text string, "
        "review_summary string, rating double, helpful_array array<bigint>, unix_review_time bigint",
    ).repartition(6)
    products = spark.createDataFrame(
        raw_products(),
        "product_id string, product_name string, brand string, price_usd double, "
        "product_description string, image_url string, categories_json string",
    ).repartition(6)
    stamp = F.lit(dt.datetime(2020, 1, 1))
    for name, df in (
        ("dates", silver.dim_date(reviews, stamp)),
        ("products", silver.dim_products(products, stamp)),
        ("reviewers", silver.dim_reviewer(reviews, stamp)),
    ):
        write_table(df, f"{root}/{name}")
    write_fact(silver.fct_review(reviews), f"{root}/fact")
    return {n: read_table(spark, f"{root}/{n}") for n in ("dates", "products", "reviewers")} | {
        "fact": read_fact(spark, f"{root}/fact")
    }


@pytest.fixture(params=["broadcast", "shuffled", "static"])
def strategy(request, conf):
    """Small dimensions; dimensions too big to broadcast; no adaptive execution."""
    if request.param != "broadcast":
        conf(spark__sql__autoBroadcastJoinThreshold="-1")
        conf(spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    if request.param == "shuffled":
        conf(
            spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2KB",
            spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.1",
            spark__sql__adaptive__advisoryPartitionSizeInBytes="1KB",
        )
    if request.param == "static":
        conf(spark__sql__adaptive__enabled="false")


def category(product):
    return "C0" if product == "hot" else f"C{int(product[1:]) % 7}"


def brand(product):
    return "H" if product == "hot" else f"B{int(product[1:]) % 3}"


def day_of(row):
    return dt.date(1970, 1, 1) + dt.timedelta(days=row[7] // DAY)


def test_category_mart(star, strategy):
    rows = raw_reviews()
    reviewed = defaultdict(set)
    for r in rows:
        reviewed[category(r[1])].add(r[1])
    top = sorted(reviewed, key=lambda c: (-len(reviewed[c]), c))[:5]
    ratings = defaultdict(list)
    for r in rows:
        if category(r[1]) in top:
            ratings[day_of(r).replace(day=1), category(r[1])].append(r[5])
    got = gold.category_ratings_monthly(star["fact"], star["products"], star["dates"]).collect()
    assert {(r.year_month, r.primary_category): r.avg_rating for r in got} == {
        k: sum(v) / len(v) for k, v in ratings.items()
    }


def test_brand_mart(star, strategy):
    total, people = Counter(), defaultdict(set)
    for r in raw_reviews():
        total[brand(r[1])] += 1
        people[brand(r[1])].add(r[0])
    got = gold.brand_repeated_reviewers(star["fact"], star["products"]).collect()
    averages = {b: int(total[b] / len(people[b]) * 100 + 0.5) / 100 for b in total}
    assert {r.brand: tuple(r)[1:] for r in got} == {
        b: (total[b], len(people[b]), a, 1 + sum(o > a for o in averages.values()))
        for b, a in averages.items()
    }


def test_reviewer_marts(star, strategy):
    counts = Counter(r[0] for r in raw_reviews())
    got = gold.reviews_per_reviewer(star["fact"]).collect()
    assert {r.reviewer_id: r.review_count for r in got} == counts
    named = {}
    for r in sorted((r for r in raw_reviews() if r[2]), key=lambda r: r[7]):
        named[r[0]] = r[2]
    assert {r.reviewer_id: r.reviewer_name for r in star["reviewers"].collect()} == {
        k: named.get(k) for k in counts
    }


def test_day_marts(star, strategy):
    days, per_day = Counter(), Counter(day_of(r) for r in raw_reviews())
    for day, n in per_day.items():
        days["Weekend" if day.weekday() > 4 else "Weekday"] += n
    got = gold.weekend_review_behavior(star["fact"], star["dates"]).collect()
    assert {r.day_type: r.total_reviews for r in got} == days
    seasons = gold.seasonality_and_reviews(star["fact"], star["dates"]).collect()
    assert sum(r.total_reviews for r in seasons) == N


def test_the_best_of_many_copies_is_kept(star):
    kept = star["products"].where("product_id = 'hot'").collect()
    assert [r.product_name for r in kept] == ["best"]


def test_suite(star, strategy):
    tables = suite.Tables(None, None, star["dates"], star["products"], star["reviewers"], star["fact"])
    results = {r.check_name: r.n_failed for r in suite.silver_summary(tables, dt.date(1971, 1, 1)).collect()}
    late = sum(day_of(r) > dt.date(1971, 1, 1) for r in raw_reviews())
    votes = sum(r[6][0] > r[6][1] for r in raw_reviews())
    assert {k: v for k, v in results.items() if v} == {
        "fact_no_future_reviews": late, "fact_helpful_votes_valid": votes,
    }


def plan_of(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def fact_columns(plan):
    """Columns read from the fact, per scan (the fact is the one with month folders)."""
    scans = re.findall(r"Location: (.*)\n(?:PartitionFilters.*\n)?(?:PushedFilters.*\n)?ReadSchema: struct<(.*)>", plan)
    return sorted(
        sorted(c.split(":")[0] for c in schema.split(",")) for where, schema in scans if "/fact" in where
    )


def test_marts_read_only_their_columns(star):
    fact, products, dates = star["fact"], star["products"], star["dates"]
    expected = {
        gold.weekend_review_behavior(fact, dates): [["date_id"]],
        gold.seasonality_and_reviews(fact, dates): [["date_id", "helpful_votes"]],
        gold.reviews_per_reviewer(fact): [["reviewer_id"]],
        gold.category_ratings_monthly(fact, products, dates): [
            ["date_id", "product_id", "rating"], ["product_id"],
        ],
    }
    for mart, columns in expected.items():
        assert fact_columns(plan_of(mart)) == columns


def test_no_plan_pairs_everything_with_everything(star, strategy):
    fact, products, dates = star["fact"], star["products"], star["dates"]
    for mart in (
        gold.category_ratings_monthly(fact, products, dates),
        gold.brand_repeated_reviewers(fact, products),
        gold.weekend_review_behavior(fact, dates),
        suite.silver_summary(suite.Tables(None, None, **star), dt.date(2020, 1, 1)),
    ):
        plan = plan_of(mart)
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_keys_as_bytes_stay_distinct(spark):
    keys = ["ab", "6162", "0" * 32, "F" * 32, "f" * 32, "\x00" * 16, "", "a" * 16, "a" * 32]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").select(suite._digest("k").alias("b")).collect()
    assert len({bytes(r.b) for r in rows}) == len(keys)
