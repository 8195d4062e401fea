"""From loose record lines to JSON text.

A line is a record if it is strict JSON or, failing that, a Python literal.
Three routes, each line on the cheapest that is exact for it:

1. strict JSON passes through, checked on the JVM;
2. a plain quoted literal (no escapes, no bare words) is JSON with other quotes,
   which the JVM's JSON reader takes;
3. whatever is left goes to Python in Arrow batches.

The JVM reader ignores text after the first value. So the line is read as the
first element of an array that ends in a marker: only if the marker turns up as
the second element did the line hold one whole value and nothing else.
"""

from __future__ import annotations

import ast
import json
import sys
import time

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from revlens.sinks.tables import make_folder, path_exists, unsorted_writers
from revlens.sources.lines import POSITION, input_bytes, normalize_lines, read_positioned, require_utf8

END_MARKER = "~revlens-end-of-record~"

# How a strict object can start. Other lines with a brace are spared the attempt,
# as a failed parse costs far more than a successful one.
_OBJECT_START = r"^\{\s*[\"}]"

# A literal leaves route 2 when the two grammars, or their printed numbers, could
# differ: escapes; bare words (JSON's are no Python, Python's no JSON); numbers
# beyond exact doubles; whole floats, which Python prints as "9.0"; and string
# prefixes. Bare tokens stand at the start or after a separator.
_UNSAFE_LITERAL = (
    r"\\|[{:,\[]\s*[bruBRU]+[\"']|(?:^|[:,\[])\s*(?:"
    r"true|false|null|None|True|False|[-+]?(?:NaN|INF|Infinity)"
    r"|[-+]?[0-9]+\.0+(?![0-9])|-?[0-9.]{16})"
)


def _closed(line: Column) -> Column:
    return F.concat(F.lit("["), line, F.lit(f',"{END_MARKER}"]'))


def _is_whole(parsed: Column, line: Column) -> Column:
    second = F.try_variant_get(parsed, "$[1]", "string")
    return F.coalesce(second == END_MARKER, F.lit(False)) & ~F.contains(
        line, F.lit(END_MARKER)
    )


def is_strict_json(line: Column) -> Column:
    """True if the line is exactly one JSON value."""
    possible = ~line.startswith("{") | line.rlike(_OBJECT_START)
    return _is_whole(F.try_parse_json(F.when(possible, _closed(line))), line)


# Ship the function below with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _repair(line: str) -> str | None:
    for parse in (json.loads, ast.literal_eval):
        try:
            text = json.dumps(parse(line), ensure_ascii=False)
            text.encode("utf-8")
            return text
        except (ValueError, SyntaxError, TypeError, RecursionError, MemoryError):
            continue
    return None


@F.pandas_udf(StringType())
def repair_records(lines: pd.Series) -> pd.Series:
    """JSON text of strict or literal records, null where neither reading works."""
    return lines.map(_repair, na_action="ignore").astype(object)


def once(df: DataFrame, *columns: Column) -> DataFrame:
    """``df`` with more columns, each computed once a row.

    Of a plain projection every later use, also in a filter, is a computation of its own; what
    a generator yields is not put into its uses.
    """
    return df.select("*", F.inline(F.array(F.struct(*columns))))


def clean_records(lines: DataFrame, native_literals: bool = True) -> DataFrame:
    """Add ``record`` (JSON text, null for a bad line) and ``route`` to ``value``.

    ``native_literals=False`` sends every literal to Python (route 3).
    """
    value = F.col("value")
    # Non-ASCII must come out raw, so lines with unicode escapes are re-encoded.
    direct = is_strict_json(value) & ~F.contains(value, F.lit("\\u"))
    staged = once(lines, F.when(direct, value).alias("_strict"))
    if native_literals:
        # An unsafe line is swapped for null before parsing, so it costs no parse.
        safe = F.when(
            F.col("_strict").isNull() & ~value.rlike(_UNSAFE_LITERAL), _closed(value)
        )
        staged = once(staged, F.from_json(safe, "variant").alias("_parsed"))
        first = F.to_json(F.try_variant_get("_parsed", "$[0]", "variant"))
        literal = F.when(_is_whole(F.col("_parsed"), value), first)
        staged = once(staged, literal.alias("_literal")).drop("_parsed")
    else:
        staged = staged.withColumn("_literal", F.lit(None).cast("string"))
    native = F.coalesce("_strict", "_literal")
    # Python sees only the rest: the other rows of a batch are nulls.
    staged = staged.withColumn("_repaired", repair_records(F.when(native.isNull(), value)))
    route = (
        F.when(F.col("_strict").isNotNull(), "strict")
        .when(F.col("_literal").isNotNull(), "literal")
        .when(F.col("_repaired").isNotNull(), "repaired")
        .otherwise("bad")
    )
    record = F.coalesce(native, "_repaired")
    return once(staged, record.alias("record"), route.alias("route")).drop("_strict", "_literal", "_repaired")


def bad_record_report(records: DataFrame) -> DataFrame:
    """One row: records kept and lines that could not be read."""
    bad = F.col("record").isNull()
    return records.agg(
        F.count_if(~bad).alias("valid_records"), F.count_if(bad).alias("parse_errors")
    )


def canonical_records(lines: DataFrame) -> DataFrame:
    """Add ``record``: the line's record written in one form, null for a bad line.

    All records pass one serialiser, whatever style they come in: keys in the order they
    have, ``", "`` and ``": "`` between tokens, the shortest form of numbers, raw non-ASCII.
    """
    return lines.withColumn("record", repair_records(F.col("value")))


KEPT = "kept"
REJECTED_LINE = "file string, block_start bigint, row bigint, line string"


def rejected_lines(spark: SparkSession, target: str) -> DataFrame:
    """Lines that ``clean_file`` found no record in, with their place."""
    path = f"{target}/{KEPT}=false"
    if not path_exists(spark, path):
        return spark.createDataFrame([], REJECTED_LINE)
    return spark.read.schema(REJECTED_LINE).json(path)


def clean_file(
    spark: SparkSession,
    source: str,
    target: str,
    partitions: int | None = None,
    sample_limit: int = 10,
) -> dict:
    """Clean a line file into newline-delimited JSON and a quarantine of bad lines, in one pass.

    Records go to the partition ``kept=true`` of ``target`` (the ``output_path`` of the
    result), bad lines with their place to ``kept=false``. Any number of them is dropped; the
    result counts them and quotes the first ``sample_limit`` in file order.
    """
    started = time.monotonic()
    seen = Observation("clean_file")
    lines = normalize_lines(require_utf8(read_positioned(spark, source, partitions)))
    bad = F.col("record").isNull()
    # Measured before the split, so that both sides are counted.
    records = canonical_records(lines).observe(
        seen,
        F.count_if(~bad).alias("valid"),
        F.count_if(bad).alias("bad"),
        F.coalesce(F.sum(F.octet_length("record")), F.lit(0)).alias("bytes"),
    )
    quarantined = F.to_json(F.struct(*POSITION, F.col("value").alias("line")))
    split = records.select(F.coalesce("record", quarantined).alias("line"), (~bad).alias(KEPT))
    with unsorted_writers(spark):
        split.write.mode("overwrite").partitionBy(KEPT).text(target)
    counts = seen.get
    output = f"{target}/{KEPT}=true"
    make_folder(spark, output)
    quoted = []
    if counts["bad"] and sample_limit:
        first = rejected_lines(spark, target).orderBy(*POSITION).limit(sample_limit)
        quoted = [row["line"] for row in first.collect()]
    return {
        "status": "success",
        "valid_records": counts["valid"],
        "parse_errors": counts["bad"],
        "bad_lines": quoted,
        "input_bytes": input_bytes(spark, source),
        "output_bytes": counts["bytes"] + counts["valid"],
        "elapsed_seconds": time.monotonic() - started,
        "output_path": output,
        "rejected_path": f"{target}/{KEPT}=false",
    }
