"""Append-only record of job runs."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession

RUN_SCHEMA = (
    "run_id string, job string, status string, rows bigint, bad_records bigint, "
    "elapsed_seconds double, details string, ended_at timestamp, input_bytes bigint, reasons string"
)


def append_run(
    spark: SparkSession,
    audit_dir: str,
    job: str,
    result: dict,
    rows: int | None = None,
    run_id: str | None = None,
) -> str:
    """Store one job's result dictionary; returns the run id."""
    run_id = run_id or uuid.uuid4().hex
    record = (
        run_id,
        job,
        result.get("status", "success"),
        rows,
        result.get("bad_records", result.get("parse_errors")),
        result.get("elapsed_seconds"),
        json.dumps(result, ensure_ascii=False, default=str, sort_keys=True),
        dt.datetime.now(dt.timezone.utc),
        result.get("input_bytes"),
        json.dumps(result.get("reasons"), sort_keys=True) if "reasons" in result else None,
    )
    spark.createDataFrame([record], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(audit_dir)
    return run_id


def read_runs(spark: SparkSession, audit_dir: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(audit_dir)
