"""Incremental fact load driven by the files that arrive.

The same rule as the batch run (recent reviews are merged on their key), with
Structured Streaming keeping track of which files were taken.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from revlens.plans.bronze import bronze_reviews
from revlens.plans.silver import fact_columns, unique_fct_review, unique_reviews
from revlens.schemas import REVIEW_LANDING
from revlens.sinks.audit import RUN_SCHEMA, append_run, read_runs
from revlens.sinks.fact import has_fact, merge_fact, write_fact
from revlens.sinks.tables import path_exists, read_table
from revlens.sources.landing import MAX_BAD_RECORDS, BadRecordBudgetExceeded, load_lines


def merge_arrivals(
    spark: SparkSession,
    landing_dir: str,
    fact_path: str,
    checkpoint_dir: str,
    as_of: dt.date,
    max_bad: int = MAX_BAD_RECORDS,
) -> DataFrame:
    """Merge the review files that are new in ``landing_dir`` and stop; returns the batches' audit.

    Each batch is parsed once, into a landing table of its own below ``checkpoint_dir``, which
    counts and sets aside bad records on the way. A batch over the budget is not merged: its
    rows stay in that table, uncommitted, the audit names it, and later batches go on. A
    batch that is run again after a failure merges the same rows to the same result. As a file may
    be delivered twice, one row per review key is taken. Like the
    batch rule, a review older than the window is not taken once the fact exists.
    """
    log = f"{checkpoint_dir}-batches/audit"

    def merge_batch(lines: DataFrame, batch: int) -> None:
        table = f"{checkpoint_dir}-batches/batch-{batch}"
        try:
            result = load_lines(lines, table, REVIEW_LANDING, max_bad)
        except BadRecordBudgetExceeded as refused:
            append_run(spark, log, f"batch-{batch}", {"status": "quarantined", "error": str(refused), "table": table})
            return
        reviews = bronze_reviews(read_table(spark, table))
        if has_fact(spark, fact_path):
            merge_fact(unique_fct_review(reviews, incremental_as_of=as_of), fact_path)
        else:
            write_fact(unique_reviews(reviews), fact_path, columns=fact_columns())
        append_run(spark, log, f"batch-{batch}", result, rows=result["rows_loaded"])

    arrivals = spark.readStream.text(landing_dir)
    query = (
        arrivals.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not path_exists(spark, log):
        return spark.createDataFrame([], RUN_SCHEMA)
    return read_runs(spark, log)
