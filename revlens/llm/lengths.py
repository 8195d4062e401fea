"""Token counts: the exact histogram of encoded lengths, and what its suffix sums answer."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.bpe import codec, default_vocabulary
from revlens.llm.common import map_arrow, rows_of, running_total, stage, table


def encoded_lengths(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) per row: tokens of the whole text; 0 for a null or empty one."""
    path = path or default_vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for batch in rows_of(batches):
            sizes = [code.count(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64())], ["doc_id", "n_tokens"]
            )

    return map_arrow(docs.select("doc_id", "text"), count, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, n_docs): one row per length that occurs, added up per task first."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """The histogram with docs_from and tokens_from: documents and tokens of this length or more."""
    falling = histogram.withColumn("_down", -F.col("n_tokens")).withColumn(
        "_tokens", F.col("n_tokens") * F.col("n_docs")
    )
    docs = running_total(falling, "n_docs", ["_down"], "docs_from")
    both = running_total(docs, "_tokens", ["_down"], "tokens_from")
    return both.select("n_tokens", "n_docs", "docs_from", "tokens_from")


def context_limits(histogram: DataFrame) -> DataFrame:
    """Per length that occurs, taken as a context limit, what the suffix sums answer.

    Columns: n_tokens (the limit), n_docs (of exactly this length), docs_from and tokens_from
    (documents and tokens of this length or more), truncated_total (tokens left if every
    document is cut at the limit), docs_over (documents that are cut) and quantile (share of
    documents within the limit). An empty histogram gives no rows.
    """
    sums = stage(suffix_sums(stage(histogram, "histogram")), "suffixes")
    # The least length holds the totals: one row.
    totals = sums.agg(F.max("docs_from").alias("_docs"), F.max("tokens_from").alias("_tokens"))
    return sums.join(F.broadcast(totals)).select(
        "n_tokens",
        "n_docs",
        "docs_from",
        "tokens_from",
        (F.col("_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias("truncated_total"),
        (F.col("docs_from") - F.col("n_docs")).alias("docs_over"),
        ((F.col("_docs") - F.col("docs_from") + F.col("n_docs")) / F.col("_docs")).alias("quantile"),
    )


def truncated_total(limits: DataFrame, limit: int) -> int:
    """Tokens left if every document is cut at ``limit``, from ``context_limits``' rows.

    The next length at or above any limit answers it; 0 for an empty table.
    """
    above = limits.filter(F.col("n_tokens") >= limit).orderBy("n_tokens").first()
    if above is None:
        return limits.agg(F.max("truncated_total")).first()[0] or 0
    cut_more = (above["n_tokens"] - limit) * above["docs_from"]
    return above["truncated_total"] - cut_more


def length_quantile(limits: DataFrame, share: float) -> int | None:
    """The least length that at least ``share`` of all documents keep to; None if empty."""
    return limits.filter(F.col("quantile") >= share).agg(F.min("n_tokens")).first()[0]


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``context_limits`` of all documents."""
    return context_limits(length_histogram(encoded_lengths(table(spark, sf_dir, "documents"))))
