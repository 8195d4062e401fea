"""Line files: scan, UTF-8 check, plain rewrite, line normalisation."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from revlens.functions import strip_line

# Lines that only carry the punctuation of an enclosing array.
PUNCTUATION_LINES = ["", "[", "]", ","]


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """One row per line in column ``value``; gzip is decoded by the reader.

    A gzip file cannot be split, so each is one task. ``partitions`` spreads the
    lines right after the scan; leave it out when there are more files than cores.
    """
    lines = spark.read.text(path)
    return lines.repartition(partitions) if partitions else lines


# Where a line lies: file, start of the scanned part of it, and row within a task's input.
# In this order, lines are in file order.
POSITION = ("file", "block_start", "row")


def read_positioned(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """``read_lines`` with the columns of ``POSITION``, which are fixed before any spreading."""
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return lines.repartition(partitions) if partitions else lines


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files that a path or pattern names, as they lie on disk."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return sum(fs.getContentSummary(s.getPath()).getLength() for s in fs.globStatus(target) or [])


def is_compressed(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern, or a file in the folder it names, is to be decompressed."""
    jvm = spark._jvm.org.apache.hadoop
    target = jvm.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    codecs = jvm.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(target) or []
    files = [file for one in found for file in fs.listStatus(one.getPath())]
    return any(codecs.getCodec(file.getPath()) is not None for file in files)


def invalid_utf8(lines: DataFrame) -> DataFrame:
    """Lines whose bytes are not valid UTF-8."""
    return lines.where(~F.is_valid_utf8("value"))


def require_utf8(lines: DataFrame) -> DataFrame:
    """Fail the job on a line that is not valid UTF-8 (Spark alone would not)."""
    return lines.withColumn("value", F.validate_utf8("value"))


def decompress(
    spark: SparkSession, source: str, target: str, partitions: int | None = None
) -> dict:
    """Rewrite compressed lines as plain text, every line kept as it is."""
    started = time.monotonic()
    counted = Observation("decompress")
    lines = require_utf8(read_lines(spark, source, partitions))
    lines.observe(counted, F.count(F.lit(1)).alias("lines")).write.mode(
        "overwrite"
    ).text(target)
    return {
        "status": "success",
        "lines_processed": counted.get["lines"],
        "elapsed_seconds": time.monotonic() - started,
        "output_path": target,
    }


def normalize_lines(lines: DataFrame) -> DataFrame:
    """Strip each line, drop array punctuation, take off exactly one trailing comma."""
    line = strip_line(F.col("value"))
    kept = lines.withColumn("value", line).where(~F.col("value").isin(PUNCTUATION_LINES))
    value = F.col("value")
    without_comma = F.left(value, F.char_length(value) - 1)
    return kept.withColumn(
        "value", F.when(value.endswith(","), without_comma).otherwise(value)
    )
