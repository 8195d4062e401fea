"""Declared schemas of the two landing tables.

``nullable=False`` marks a required field: a record without it counts as bad.
JSON-typed product fields stay compact JSON text on disk.
"""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

PRODUCT_LANDING = StructType(
    [StructField("asin", StringType(), nullable=False)]
    + [
        StructField(name, StringType())
        for name in (
            "title",
            "description",
            "price",
            "brand",
            "imUrl",
            "categories",
            "salesRank",
            "related",
        )
    ]
)

REVIEW_LANDING = StructType(
    [
        StructField("reviewerID", StringType()),
        StructField("asin", StringType()),
        StructField("reviewerName", StringType()),
        StructField("helpful", ArrayType(LongType())),
        StructField("reviewText", StringType()),
        StructField("overall", DoubleType()),
        StructField("summary", StringType()),
        StructField("unixReviewTime", LongType()),
        StructField("reviewTime", StringType()),
    ]
)
