"""Newline-delimited JSON into typed landing tables, with a bad-record budget."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    FractionalType,
    IntegralType,
    LongType,
    MapType,
    NullType,
    NumericType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from revlens.session import scratch_path
from revlens.sinks.tables import IS_BAD, REJECTED, commit_version, stage_version
from revlens.sources.lines import (
    POSITION,
    input_bytes,
    is_compressed,
    read_lines,
    read_positioned,
    require_utf8,
)
from revlens.sources.records import END_MARKER, once

MAX_BAD_RECORDS = 10

# JSON only: no single quotes, no NaN or infinity as numbers.
STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


class BadRecordBudgetExceeded(RuntimeError):
    """More bad records than a load tolerates."""


_CORRUPT, _ROWS = "_corrupt", "_rows"
NO_RECORD = "no_record"


def _read(line: Column, fields: list[StructField]) -> Column:
    """The line as first element of an array that ends in a marker object."""
    element = StructType([*fields, StructField(END_MARKER, LongType())])
    root = StructType([StructField(_ROWS, ArrayType(element)), StructField(_CORRUPT, StringType())])
    text = F.concat(F.lit(f'{{"{_ROWS}":['), line, F.lit(f',{{"{END_MARKER}":1}}]}}'))
    return F.from_json(text, root, STRICT_JSON | {"columnNameOfCorruptRecord": _CORRUPT})


def _named(column: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def _row(read: Column) -> Column:
    return F.get(read[_ROWS], F.lit(0))


def _whole(read: Column) -> Column:
    """True if the line was one JSON object whose values all fit their types."""
    second = F.get(read[_ROWS], F.lit(1))
    fits = (
        read[_CORRUPT].isNull()
        & (F.size(read[_ROWS]) == 2)
        & (second[END_MARKER] == 1)
        & _row(read).isNotNull()
    )
    return F.coalesce(fits, F.lit(False))


# JSON's own number grammar: casts alone would take suffixes, signs and words of Java.
_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
_WHOLE_NUMBER = r"^-?(0|[1-9][0-9]*)(\.0+)?$"


def _coerced(text: Column, kind: DataType) -> Column:
    if isinstance(kind, StringType):
        return text
    if isinstance(kind, (ArrayType, MapType, StructType)):
        return F.from_json(text, kind, STRICT_JSON)
    if isinstance(kind, NumericType):
        grammar = _WHOLE_NUMBER if isinstance(kind, IntegralType) else _NUMBER
        return F.when(text.rlike(grammar), text).try_cast(kind)
    return text.try_cast(kind)


def reasons(schema: StructType) -> list[str]:
    """Why a line can be bad: not one JSON object, a value of another type, a missing field."""
    typed = [f.name for f in schema if not isinstance(f.dataType, StringType)]
    required = [f.name for f in schema if not f.nullable]
    return ["not_one_object", *[f"type:{n}" for n in typed], *[f"missing:{n}" for n in required]]


def judge_ndjson(lines: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``lines``, the schema's columns and ``_reason``, one row per non-blank line.

    ``_reason`` is one of ``reasons``, or null for a good line. A line is bad if it is not
    exactly one JSON object, a value does not fit its type, or a ``nullable=False`` field is
    missing. Unknown fields are ignored. Lines are read straight into their types; only a
    line that fails is read once more as text, so that a quoted JSON number still counts as
    a number. The end marker works as in ``records``. Bytes that are not UTF-8 fail the job.
    """
    given = lines.columns
    lines = require_utf8(lines)
    value = F.col("value")
    kinds = {f.name: f.dataType for f in schema}
    typed = [StructField(name, kind) for name, kind in kinds.items()]
    unmarked = ~F.contains(value, F.lit(END_MARKER))
    rows = once(lines.where(F.trim(value) != ""), _read(value, typed).alias("_typed"))
    first = _row(F.col("_typed"))
    rows = rows.withColumn("_fits", _whole(F.col("_typed")) & unmarked)
    values = {name: first[name] for name in kinds}
    unfit = ~F.col("_fits")
    if all(isinstance(kind, StringType) for kind in kinds.values()):
        reason = F.when(unfit, F.lit("not_one_object"))
    else:
        texts = [StructField(name, StringType()) for name in kinds]
        rows = once(rows, _read(F.when(unfit, value), texts).alias("_texts"))
        second = _row(F.col("_texts"))
        coerced = {name: _coerced(second[name], kind) for name, kind in kinds.items()}
        reason = F.when(~(_whole(F.col("_texts")) & unmarked), F.lit("not_one_object"))
        for name, kind in kinds.items():
            if not isinstance(kind, StringType):
                misfit = second[name].isNotNull() & coerced[name].isNull()
                reason = reason.when(misfit, F.lit(f"type:{name}"))
        reason = F.when(unfit, reason)
        values = {
            name: F.when(unfit, coerced[name]).otherwise(typed_value)
            for name, typed_value in values.items()
        }
    missing = F.lit(None).cast("string")
    for field in reversed(schema.fields):
        if not field.nullable:
            missing = F.when(values[field.name].isNull(), F.lit(f"missing:{field.name}")).otherwise(missing)
    return rows.select(
        *given,
        *[v.alias(name) for name, v in values.items()],
        F.coalesce(reason, missing).alias("_reason"),
    )


def parse_ndjson(lines: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns plus ``_bad``, one row per non-blank line (see ``judge_ndjson``)."""
    judged = judge_ndjson(lines.select("value"), schema)
    return judged.select(*map(_named, schema.fieldNames()), F.col("_reason").isNotNull().alias("_bad"))


def infer_schema(lines: DataFrame, sampling: float = 1.0) -> StructType:
    """Schema of the objects in ``lines`` (or a share of them); unreadable lines do not count.

    The types of all lines are merged in the tasks and one description reaches the driver.
    Numbers with a fraction are doubles; fields of several types, or without one, are text.
    """
    value = F.col("value")
    objects = lines.where(F.ltrim(value).startswith("{"))
    if sampling < 1.0:
        objects = objects.where(F.pmod(F.xxhash64(value), F.lit(1 << 20)) < int(sampling * (1 << 20)))
    merged = objects.agg(F.schema_of_variant_agg(F.try_parse_json(value))).first()[0]
    if merged is None or not merged.startswith("OBJECT<"):
        return StructType()
    ddl = merged.replace("OBJECT<>", "STRING").replace("OBJECT<", "STRUCT<")
    found = lines.sparkSession.createDataFrame([], f"line {ddl}").schema["line"].dataType
    return _plain_types(found) if isinstance(found, StructType) else StructType()


def _plain_types(kind: DataType) -> DataType:
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _plain_types(f.dataType)) for f in kind])
    if isinstance(kind, ArrayType):
        return ArrayType(_plain_types(kind.elementType))
    if isinstance(kind, (DecimalType, FractionalType)):
        return DoubleType()
    return StringType() if isinstance(kind, (NullType, VariantType)) else kind


def infer_landing_schema(spark: SparkSession, path: str, sampling: float = 1.0) -> StructType:
    """``infer_schema`` of a file's lines."""
    return infer_schema(read_lines(spark, path), sampling)


def read_landing(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Flagged rows of a newline-delimited JSON path; no schema means inference."""
    schema = schema or infer_landing_schema(spark, path)
    return parse_ndjson(read_lines(spark, path), schema)


def _check(bad: int, max_bad: int) -> None:
    if bad > max_bad:
        raise BadRecordBudgetExceeded(f"{bad} bad records, {max_bad} allowed")


def enforce_budget(flagged: DataFrame, max_bad: int = MAX_BAD_RECORDS) -> DataFrame:
    """Good rows of a flagged frame; raises if more than ``max_bad`` rows are bad.

    Counts in a pass of its own. A job that writes its result anyway should use
    ``load_table``, which counts while it writes.
    """
    _check(flagged.where("_bad").count(), max_bad)
    return flagged.where(~F.col("_bad")).drop("_bad")


def load_landing(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    max_bad: int = MAX_BAD_RECORDS,
) -> DataFrame:
    """Rows of a newline-delimited JSON path within the bad-record budget."""
    return enforce_budget(read_landing(spark, path, schema), max_bad)


def load_lines(
    lines: DataFrame,
    table_dir: str,
    schema: StructType,
    max_bad: int = MAX_BAD_RECORDS,
    tolerated: str | None = None,
) -> dict:
    """Replace a landing table by the records in ``lines``, in one pass over them.

    Good and bad rows go to two partitions of a staged version, bad ones with their line and
    reason. It becomes the table if the bad ones are within the budget; ``rejected_records``
    reads them. Beyond the budget the version stays, uncommitted, for a look at it. Lines
    whose column ``tolerated`` is true are rejected as ``no_record`` outside the budget.
    """
    started = time.monotonic()
    seen = Observation("load_lines")
    known, reason = [NO_RECORD, *reasons(schema)], F.col("_reason")
    place = [c for c in POSITION if c in lines.columns]
    rejected = F.when(
        reason.isNotNull(), F.struct(*place, F.col("value").alias("line"), reason.alias("reason"))
    )
    judged = judge_ndjson(lines, schema)
    if tolerated:
        judged = judged.withColumn("_reason", F.when(F.col(tolerated), NO_RECORD).otherwise(reason))
    judged = judged.observe(
        seen,
        F.count_if(reason.isNull()).alias("good"),
        F.count_if(reason != NO_RECORD).alias("bad"),
        *[F.count_if(reason == r).alias(f"r{i}") for i, r in enumerate(known)],
    )
    rows = judged.select(
        *[F.when(reason.isNull(), _named(c)).alias(c) for c in schema.fieldNames()],
        rejected.alias(REJECTED),
        reason.isNotNull().alias(IS_BAD),
    )
    staged = stage_version(rows, table_dir, (IS_BAD,))
    counts = seen.get
    result = {
        "status": "success",
        "rows_loaded": counts["good"],
        "bad_records": counts["bad"],
        "parse_errors": counts["r0"],
        "reasons": {r: counts[f"r{i}"] for i, r in enumerate(known) if counts[f"r{i}"]},
        "elapsed_seconds": time.monotonic() - started,
        "output_table": table_dir,
    }
    if counts["bad"] > max_bad:
        raise BadRecordBudgetExceeded(
            f"{counts['bad']} bad records, {max_bad} allowed: {result['reasons']}; see {staged}"
        )
    commit_version(lines.sparkSession, table_dir, staged, rows)
    return result


def load_table(
    spark: SparkSession,
    path: str,
    table_dir: str,
    schema: StructType | None = None,
    max_bad: int = MAX_BAD_RECORDS,
    partitions: int | None = None,
) -> dict:
    """Replace a landing table by a newline-delimited JSON path, plain or gzip.

    Spark reads compressed lines of any size, so they need no plain copy first; ``partitions``
    spreads the lines of a few large gzip files over the cores. Without a schema the lines of
    compressed files are staged on their one reading, and both inference and load use the
    staged copy; plain files are read by both, which is cheaper than a copy.
    """
    lines = read_positioned(spark, path, partitions)
    if schema is None and is_compressed(spark, path):
        staged = scratch_path(spark, "lines")
        lines.write.parquet(staged)
        lines = spark.read.schema(lines.schema).parquet(staged)
    schema = schema or infer_schema(lines.select("value"))
    result = load_lines(lines, table_dir, schema, max_bad)
    return result | {"input_bytes": input_bytes(spark, path)}
