"""Landing tables (and the raw lines behind them) from the driver's tables.

The mapping is the one of FIXTURES.md. It plants nulls, duplicates, orphans, bad
vote counts and odd prices so that every operator has something to do.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

C = F.col


def shared(define):
    """Define a frame once per session and folder (its plan, not its data)."""
    return functools.lru_cache(maxsize=None)(define)


@shared
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _divides(column: str, divisor: int) -> Column:
    return C(column) % divisor == 0


def _epoch_seconds(ts: str) -> Column:
    """Seconds of a zone-less timestamp read as UTC, whatever the session zone."""
    days = F.unix_date(C(ts).cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


@shared
def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing table of reviews: one per line item."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    # The line items, of which there are most, join last and so are shuffled once at most.
    ordered = orders.join(customers, C("o_custkey") == C("c_custkey"))
    joined = lines.join(ordered, C("l_orderkey") == C("o_orderkey"))
    up = C("l_quantity").cast("bigint") % 5
    total = up + C("l_linenumber") % 4 - 1
    return joined.select(
        F.when(~_divides("o_orderkey", 211), C("o_custkey").cast("string")).alias("reviewerID"),
        C("l_partkey").cast("string").alias("asin"),
        F.when(
            ~_divides("o_orderkey", 5),
            F.concat("c_name", F.lit("-"), (C("o_orderkey") % 3).cast("string")),
        ).alias("reviewerName"),
        F.when(_divides("l_linenumber", 7), F.array().cast("array<bigint>"))
        .otherwise(F.array(up, total))
        .alias("helpful"),
        F.when(_divides("l_linenumber", 6), None)
        .when(_divides("o_orderkey", 89), "")
        .otherwise(F.repeat("l_returnflag", C("l_quantity").cast("int")))
        .alias("reviewText"),
        (1 + C("l_linenumber") % 5).cast("double").alias("overall"),
        F.concat("l_returnflag", "l_linestatus").alias("summary"),
        F.when(~_divides("o_orderkey", 97), _epoch_seconds("o_orderdate")).alias("unixReviewTime"),
        F.date_format("o_orderdate", "MM d, yyyy").alias("reviewTime"),
    )


@shared
def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with nested fields still nested, plus near-empty duplicates."""
    part = table(spark, sf_dir, "part")
    full = part.select(
        "p_partkey",
        F.lit(False).alias("is_copy"),
        C("p_partkey").cast("string").alias("asin"),
        C("p_name").alias("title"),
        F.when(~_divides("p_partkey", 4), F.concat_ws(" ", "p_name", "p_type")).alias(
            "description"
        ),
        F.when(_divides("p_partkey", 9), None)
        .when(_divides("p_partkey", 53), "-1")
        .when(_divides("p_partkey", 59), "20000")
        .otherwise(C("p_retailprice").cast("string"))
        .alias("price"),
        F.when(_divides("p_partkey", 11), "  ")
        .when(~_divides("p_partkey", 13), C("p_brand"))
        .alias("brand"),
        F.concat(F.lit("http://img/"), C("p_partkey").cast("string")).alias("imUrl"),
        F.when(~_divides("p_partkey", 17), F.array(F.array("p_type", "p_name"))).alias(
            "categories"
        ),
        F.create_map(C("p_type"), C("p_size")).alias("salesRank"),
        F.create_map(F.lit("also_bought"), F.array().cast("array<string>")).alias("related"),
    )
    copies = full.where(_divides("p_partkey", 10)).select(
        "p_partkey",
        F.lit(True).alias("is_copy"),
        "asin",
        F.concat("title", F.lit(" dup")).alias("title"),
        *[
            F.lit(None).cast(full.schema[c].dataType).alias(c)
            for c in full.columns
            if c not in ("p_partkey", "is_copy", "asin", "title")
        ],
    )
    return full.unionByName(copies)


PRODUCT_FIELDS = [
    "asin", "title", "description", "price", "brand", "imUrl", "categories", "salesRank", "related",
]
NESTED_FIELDS = ("categories", "salesRank", "related")


@shared
def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing table of products; nested fields as JSON text."""
    return _products(spark, sf_dir).select(
        *[F.to_json(c).alias(c) if c in NESTED_FIELDS else C(c) for c in PRODUCT_FIELDS]
    )


@shared
def metadata_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw product lines in the styles a crawl delivers, ``value`` per line.

    By key modulo 8: strict JSON (0, 4, 5), strict with a trailing comma (1),
    quoted literal (2), literal with ``None`` (3), literal with ``u''`` keys (6),
    tab-padded literal with a trailing comma (7). Keys divisible by 25 add a line
    that is no record and keys divisible by 40 a line of array punctuation.
    """
    # The file of parts is small and so few tasks scan it; its lines cost far more than its bytes.
    products = _products(spark, sf_dir).repartition("p_partkey")
    sparse = F.to_json(F.struct(*PRODUCT_FIELDS))
    full = F.to_json(F.struct(*PRODUCT_FIELDS), {"ignoreNullFields": "false"})
    literal = F.translate(sparse, '"', "'")
    with_none = F.replace(F.translate(full, '"', "'"), F.lit(":null"), F.lit(": None"))
    prefixed = F.replace(literal, F.lit("'title'"), F.lit("u'title'"))
    style = C("p_partkey") % 8
    line = (
        F.when(style == 1, F.concat(sparse, F.lit(",")))
        .when(style == 2, literal)
        .when(style == 3, with_none)
        .when(style == 6, prefixed)
        .when(style == 7, F.concat(F.lit("\t"), literal, F.lit(", \t")))
        .otherwise(sparse)
    )
    noise = F.when(
        _divides("p_partkey", 25) & ~C("is_copy"), F.concat(F.lit("{'asin': "), "asin", F.lit(" oops"))
    )
    frame = F.when(
        _divides("p_partkey", 40) & ~C("is_copy"),
        F.element_at(
            F.array(F.lit("["), F.lit(" ] "), F.lit(","), F.lit("")),
            (C("p_partkey") / 40 % 4 + 1).cast("int"),
        ),
    )
    lines = F.explode(F.array_compact(F.array(line, noise, frame)))
    return products.select(lines.alias("value"))


@shared
def odd_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict JSON lines whose keys are in no order and whose numbers are not in short form."""
    part = table(spark, sf_dir, "part").where(_divides("p_partkey", 3))
    line = F.concat(
        F.lit('{"z":'),
        C("p_retailprice").cast("string"),
        F.lit('0,"b" : {"y":1e22,"a":[1.50,-0.0,  12,9.90]},"asin":"'),
        C("p_partkey").cast("string"),
        F.lit('","\u00fc":"\\u00e9"}'),
    )
    return part.select(line.alias("value"))


@shared
def item_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews as newline-delimited JSON, ``value`` per line."""
    reviews = items(spark, sf_dir)
    return reviews.select(F.to_json(F.struct(*reviews.columns)).alias("value"))
