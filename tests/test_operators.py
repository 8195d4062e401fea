import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from revlens.operators import (
    join_dimension,
    keep_first,
    latest_name,
    merge_upsert,
    rank_descending,
    sample_rows,
    top_k,
)
from revlens.operators import checks
from revlens.operators.joins import join_salted
from revlens.operators.merge import merge_whole


def final_plan(spark, df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


# --- dedup


def test_keep_first(frame, rows):
    df = frame("k string, v int", ("a", 2), ("a", 1), ("b", 5), (None, 3), (None, 4))
    assert rows(keep_first(df, "k", F.col("v"))) == [("a", 1), ("b", 5), (None, 3)]


def test_keep_first_limits_before_the_shuffle(frame, spark):
    plan = final_plan(spark, keep_first(frame("k string, v int", ("a", 2)), "k", F.col("v")))
    assert "WindowGroupLimit" in plan.split("Exchange")[-1]


def names(frame, *data):
    df = frame("r string, n string, t bigint", *data)
    return [tuple(x) for x in latest_name(df, "r", "n", "t", "first").orderBy("r").collect()]


@pytest.mark.parametrize(
    ("data", "expected"),
    [
        ([("r", None, 1), ("r", None, 2)], ("r", None, 1)),
        ([("r", None, 9), ("r", "old", 2), ("r", "older", 1)], ("r", "old", 1)),
        ([("r", "untimed", None), ("r", "timed", 1)], ("r", "timed", 1)),
        ([("r", "untimed", None), ("r", None, 5)], ("r", "untimed", 5)),
        ([("r", "b", 3), ("r", "a", 3)], ("r", "a", 3)),
        ([("r", "a", 1), ("r", "b", 2), ("r", "a", 3)], ("r", "a", 1)),
        ([("r", "a", None)], ("r", "a", None)),
    ],
)
def test_latest_name(frame, data, expected):
    assert names(frame, *data, (None, "ghost", 1)) == [expected]


review = st.tuples(
    st.sampled_from(["r1", "r2", None]),
    st.sampled_from(["a", "b", None]),
    st.integers(1, 4) | st.none(),
)


@settings(max_examples=15, deadline=None)
@given(st.lists(review, min_size=1, max_size=25))
def test_latest_name_matches_a_sort(spark, data):
    df = spark.createDataFrame(data, "r string, n string, t bigint")
    got = {x.r: (x.n, x.first) for x in latest_name(df, "r", "n", "t", "first").collect()}
    expected = {}
    for r in {r for r, _, _ in data if r}:
        mine = [(n, t) for k, n, t in data if k == r]
        best = min(mine, key=lambda x: (x[0] is None, x[1] is None, -(x[1] or 0), x[0] or ""))
        expected[r] = (best[0], min((t for _, t in mine if t is not None), default=None))
    assert got == expected


# --- joins


def test_join_dimension(frame, rows):
    facts = frame("k string, v int", ("a", 1), ("a", 2), ("b", 3), (None, 4))
    dim = frame("k string, d string", ("a", "A"), ("c", "C"))
    expected = [("a", 1, "A"), ("a", 2, "A")]
    assert rows(join_dimension(facts, dim, "k")) == expected
    assert rows(join_salted(facts, dim, "k")) == expected


@pytest.fixture
def skewed(spark):
    """60,000 facts, a third of them on one key, and a dimension row per key."""
    facts = spark.range(0, 60000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("k"),
        F.col("id").alias("v"),
        F.repeat(F.lit("x"), 50).alias("pad"),
    )
    dim = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    return facts, dim


def check_skewed_result(joined):
    row = joined.agg(
        F.count("*").alias("n"), F.sum("d").alias("d"), F.countDistinct("v").alias("v")
    ).first()
    keys = [7 if i % 3 == 0 else i % 5000 for i in range(60000)]
    assert tuple(row) == (60000, sum(2 * k for k in keys), 60000)


def test_adaptive_execution_splits_a_hot_key(spark, skewed, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    facts, dim = skewed
    joined = join_dimension(facts, dim, "k")
    check_skewed_result(joined)
    assert "skew=true" in final_plan(spark, joined)


def test_hot_keys_are_salted_without_adaptive_execution(spark, skewed, conf):
    conf(
        spark__sql__adaptive__enabled="false",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
    )
    facts, dim = skewed
    joined = join_dimension(facts, dim, "k")
    check_skewed_result(joined)
    assert "_salt" in final_plan(spark, joined)
    sizes = [r.n for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 60000 / 4


def test_join_salted_keeps_cold_keys_unsalted(frame, rows):
    facts = frame("k int, v int", *[(i, i) for i in range(3)])
    dim = frame("k int, d int", *[(i, -i) for i in range(3)])
    assert rows(join_salted(facts, dim, "k")) == [(0, 0, 0), (1, 1, -1), (2, 2, -2)]


# --- rank, top-k, sample


def test_rank_has_gaps_after_ties(frame, rows):
    df = frame("b string, a double", ("w", 2.0), ("x", 1.5), ("y", 2.0), ("z", 1.0))
    ranked = rank_descending(df, "a", "rk")
    assert rows(ranked) == [("w", 2.0, 1), ("x", 1.5, 3), ("y", 2.0, 1), ("z", 1.0, 4)]
    assert dict(ranked.dtypes)["rk"] == "bigint"


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(100, 130), min_size=1, max_size=40))
def test_rank_matches_counting(spark, cents):
    df = spark.createDataFrame([(i, c / 100) for i, c in enumerate(cents)], "i int, a double")
    got = {r.i: r.rk for r in rank_descending(df, "a", "rk").collect()}
    assert got == {i: 1 + sum(o > c for o in cents) for i, c in enumerate(cents)}


def test_top_k_breaks_ties(frame):
    df = frame("c string, n int", ("f", 1), ("e", 1), ("a", 3))
    got = [tuple(r) for r in top_k(df, 2, F.col("n").desc(), F.col("c")).collect()]
    assert got == [("a", 3), ("e", 1)]
    assert top_k(df, 5, F.col("n"), F.col("c")).count() == 3


def test_sample_is_repeatable(spark):
    df = spark.range(10000)
    share = sample_rows(df)
    assert 800 < share.count() < 1200 and share.collect() == sample_rows(df).collect()


# --- merge

TABLE = "k string, a string, b int"


def test_merge_updates_inserts_and_keeps(frame, rows):
    target = frame(TABLE, ("u", "old", 1), ("n", "old", 2), ("keep", "old", 3), (None, "t", 4))
    source = frame(TABLE, ("u", "new", 10), ("n", None, None), ("ins", "new", 30), (None, "s", 40))
    assert rows(merge_upsert(target, source, "k")) == [
        ("ins", "new", 30),
        ("keep", "old", 3),
        ("n", None, None),
        ("u", "new", 10),
        (None, "s", 40),
        (None, "t", 4),
    ]


def test_merge_updates_only_listed_columns(frame, rows):
    target = frame(TABLE, ("u", "old", 1))
    source = frame(TABLE, ("u", "new", 10), ("ins", "new", 20))
    merged = merge_upsert(target, source, "k", ["a"])
    assert rows(merged) == [("ins", "new", 20), ("u", "new", 1)]


def test_merge_rejects_several_matches(frame, rows):
    target = frame(TABLE, ("u", "old", 1))
    twice = frame(TABLE, ("u", "x", 1), ("u", "y", 2))
    for updates in (None, [], ["b"]):
        with pytest.raises(PySparkException, match="several source rows match k = u"):
            merge_upsert(target, twice, "k", updates).collect()
    unmatched = frame(TABLE, ("v", "x", 1), ("v", "y", 2))
    assert len(rows(merge_upsert(target, unmatched, "k"))) == 3


def test_merge_into_an_empty_target(frame, rows):
    source = frame(TABLE, ("a", "x", 1))
    assert rows(merge_upsert(source.limit(0), source, "k")) == [("a", "x", 1)]


def test_merge_with_a_small_source_does_not_shuffle_the_target(spark, conf):
    big = spark.range(0, 200000, 1, 8).select(
        F.col("id").alias("k"), F.repeat(F.lit("t"), 100).alias("a")
    )
    conf(spark__sql__autoBroadcastJoinThreshold="200KB")
    small = spark.range(199990, 200010).select(F.col("id").alias("k"), F.lit("s").alias("a"))
    merged = merge_upsert(big, small, "k")
    assert merged.count() == 200010 and merged.where("a = 's'").count() == 20
    plan = final_plan(spark, merged).split("Initial Plan")[0]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


key_rows = st.dictionaries(st.integers(0, 6), st.tuples(st.text("xy", max_size=2), st.integers(0, 9)))


@settings(max_examples=12, deadline=None)
@given(key_rows, key_rows)
def test_merge_matches_a_dictionary_and_is_idempotent(spark, old, new):
    def df(d):
        return spark.createDataFrame([(k, *v) for k, v in d.items()], "k int, a string, b int")

    once = merge_upsert(df(old), df(new), "k")
    expected = sorted((k, *v) for k, v in (old | new).items())
    assert sorted(map(tuple, once.collect())) == expected
    assert sorted(map(tuple, merge_upsert(once, df(new), "k").collect())) == expected


def test_merge_matches_the_sql_statement(frame, rows):
    duckdb = pytest.importorskip("duckdb")
    target = [("u", "old", 1), ("n", "old", 2), ("keep", "old", 3), (None, "t", 4)]
    source = [("u", "new", 10), ("n", None, None), ("ins", "new", 30), (None, "s", 40)]
    con = duckdb.connect()
    for name, data in (("t", target), ("s", source)):
        con.execute(f"CREATE TABLE {name} (k VARCHAR, a VARCHAR, b INTEGER)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?, ?)", data)
    con.execute(
        "MERGE INTO t USING s ON t.k = s.k WHEN MATCHED THEN UPDATE SET a = s.a "
        "WHEN NOT MATCHED THEN INSERT VALUES (s.k, s.a, s.b)"
    )
    expected = sorted(con.sql("FROM t").fetchall(), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert rows(merge_upsert(frame(TABLE, *target), frame(TABLE, *source), "k", ["a"])) == expected


# --- checks


def test_not_null_and_unique(frame, rows):
    df = frame("k string, v int", ("a", 1), ("a", 2), (None, 3), (None, 4), ("b", 5))
    assert rows(checks.check_not_null(df, "k")) == [(None, 3), (None, 4)]
    assert rows(checks.check_unique(df, "k")) == [("a", 2)]


def test_accepted_values(frame, rows):
    df = frame("m bigint", (1,), (13,), (13,), (0,), (None,))
    assert rows(checks.check_accepted_values(df, "m", list(range(1, 13)))) == [(0, 1), (13, 2)]
    ratings = frame("r double", (5.0,), (5.5,), (None,))
    assert rows(checks.check_accepted_values(ratings, "r", [1.0, 5.0])) == [(5.5, 1)]


def test_relationship(frame, rows):
    child = frame("k string", ("a",), ("x",), ("x",), (None,))
    parent = frame("id string", ("a",), ("b",))
    assert rows(checks.check_relationship(child, "k", parent, "id")) == [("x", 2)]


def test_range_and_length(frame, rows):
    df = frame("p double, t string", (0.0, "é"), (10000.0, ""), (10000.5, None), (-1.0, "ab"), (None, "a"))
    assert rows(checks.check_between(df, "p", 0, 10000)) == [(-1.0, "ab"), (10000.5, None)]
    assert rows(checks.check_length_between(df, "t", 1, 1)) == [(-1.0, "ab"), (10000.0, "")]


def test_votes_and_future(frame, rows):
    fact = frame(
        "review_sk string, helpful_votes bigint, total_votes bigint, review_date date",
        ("ok", 1, 1, dt.date(2020, 1, 2)),
        ("bad", 2, 1, dt.date(2020, 1, 3)),
        ("none", None, 1, None),
        ("part", 3, None, dt.date(2020, 1, 1)),
    )
    assert rows(checks.check_helpful_votes(fact)) == [("bad", 2, 1)]
    today = dt.date(2020, 1, 2)
    assert rows(checks.check_no_future_reviews(fact, today)) == [("bad", dt.date(2020, 1, 3), today)]


def test_sample_by_key_does_not_depend_on_the_layout(spark):
    from pyspark.sql import functions as F

    from revlens.operators import sample_keys

    df = spark.range(2000).select("id", F.md5(F.col("id").cast("string")).alias("k"))
    share = sorted(r.id for r in sample_keys(df, "k").collect())
    assert 120 < len(share) < 280
    assert share == sorted(r.id for r in sample_keys(df.repartition(7), "k").collect())
    assert sample_keys(df, "k", 1.0).count() == 2000


def test_merge_with_a_target_key_in_a_third_of_the_rows(spark):
    from revlens.operators.merge import merge_upsert

    target = spark.createDataFrame([("hot", i) for i in range(300)] + [(f"k{i}", i) for i in range(600)], "k string, v int")
    source = spark.createDataFrame([("hot", -1), ("new", -2)], "k string, v int")
    rows = [tuple(r) for r in merge_upsert(target, source, "k").collect()]
    assert len(rows) == 901 and rows.count(("hot", -1)) == 300 and ("new", -2) in rows


# --- the merge as one full outer join


def merge_cases():
    target = [("a", "one", 1), ("b", "two", 2), (None, "no key", 3), (None, "no key", 3), ("d", None, 4)]
    source = [("a", None, 9), ("c", "new", 5), ("c", "new", 6), (None, "x", 7), ("d", "d", 8)]
    return target, source


@pytest.mark.parametrize("updates", [None, ["v"], []])
def test_both_merges_agree(frame, rows, updates):
    schema = "k string, v string, n int"
    target, source = merge_cases()
    got = [f(frame(schema, *target), frame(schema, *source), "k", updates) for f in (merge_upsert, merge_whole)]
    assert rows(got[0]) == rows(got[1]) and got[1].count() == 8


def test_whole_merge_refuses_several_matches(frame):
    schema = "k string, n int"
    with pytest.raises(Exception, match="several source rows match k = a"):
        merge_whole(frame(schema, ("a", 1)), frame(schema, ("a", 2), ("a", 3)), "k").collect()


def test_whole_merge_of_a_hot_target_key_and_keyless_rows(spark):
    target = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"),
        F.col("id").alias("n"),
    )
    source = spark.createDataFrame([("hot", -1), ("new", -2), (None, -3)], "k string, n bigint")
    got = {r["k"]: (r["c"], r["s"]) for r in merge_whole(target, source, "k").groupBy("k").agg(
        F.count("*").alias("c"), F.sum("n").alias("s")).collect()}
    assert got["hot"] == (1000, -1000) and got["new"] == (1, -2) and got[None][0] == 1001 and len(got) == 1003


def test_whole_merge_reads_and_shuffles_each_side_once(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    for side in ("old", "new"):
        spark.range(100).select(F.col("id").cast("string").alias("k"), "id").write.parquet(f"{tmp_path}/{side}")
    merged = merge_whole(*[spark.read.parquet(f"{tmp_path}/{side}") for side in ("old", "new")], "k")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("FileScan") == 2
    assert merged.count() == 100


def test_rank_of_many_doubles_needs_no_single_task(spark, conf):
    conf(spark__sql__shuffle__partitions="7")
    df = spark.range(0, 5000, 1, 5).select((F.xxhash64("id") / 1e12).alias("v"), "id").unionByName(
        spark.createDataFrame([(v, -i) for i, v in enumerate([float("nan"), float("inf"), -0.0, 0.0, None, 0.0, 1e-300], 1)], "v double, id bigint")
    )
    ranked = rank_descending(df, "v", "r")
    expected = {r["id"]: r["r"] for r in df.selectExpr("id", "rank() over (order by v desc) r").collect()}
    assert {r["id"]: r["r"] for r in ranked.collect()} == expected
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Window [" in plan and all("_slice" in line for line in plan.splitlines() if "Window [" in line)
