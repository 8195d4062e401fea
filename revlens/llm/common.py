"""Helpers that several corpus operators share.

Intermediate tables go below the folder in ``spark.checkpoint.dir`` (see
``revlens.session.scratch_path``), so lost executors cost no recomputation beyond them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revlens.session import scratch_path
from revlens.sinks.tables import remove_folder

# Words of a text: runs of anything but ASCII blanks. On UTF-8 bytes this is bytes.split().
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*staged: DataFrame) -> None:
    """Remove the folders of staged frames that nothing reads any more."""
    for df in staged:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            if folder.split("/")[-2] != "revlens":
                raise ValueError(f"not a staged folder: {folder}")
            remove_folder(df.sparkSession, folder)


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def count_words(text: Column) -> Column:
    """Number of words as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids give null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def running_total(
    df: DataFrame, value: str, order: list[str], total: str, group: list[str] | None = None
) -> DataFrame:
    """``df`` with the running sum of ``value`` in ``order``, per ``group`` if given.

    No group and no order has to fit one task: rows are range-partitioned by group and
    order, slices are summed where they lie, and each row adds its position within the
    slice to what the slices before it hold. Slices are written first, so that a rerun
    task finds the same ones. Group columns must not be null.
    """
    group = group or []
    slices = df.repartitionByRange(
        shuffle_width(df.sparkSession), *[F.col(c) for c in group + order]
    ).withColumn("_slice", F.spark_partition_id())
    staged = stage(slices, "slices")
    sums = staged.groupBy(*group, "_slice").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sums.select(
        *group, "_slice", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy(*group, "_slice").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    return (
        staged.join(starts, [*group, "_slice"])
        .withColumn(total, F.col("_start") + F.sum(value).over(within))
        .drop("_slice", "_start")
    )


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b: long): rows (node, root).

    ``root`` is the smallest node reachable; every node of an edge appears once. Alternates
    the large-star and small-star steps, each a minimum per node and a join, until no edge
    changes; every step is written, so lineage stays short. Rounds grow with the logarithm
    of the longest chain. Only a row count and a checksum reach the driver.
    """
    links = stage(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    seen = _fingerprint(links)
    while seen[0]:
        links = stage(_small_star(_large_star(links)), "links")
        now = _fingerprint(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _fingerprint(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
    return row[0], row[1]


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its smallest neighbour (or itself)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return (
        both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, move to the smallest one."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.unionByName(own).filter("a <> b").distinct()


def rows_of(batches: Iterator[pa.RecordBatch], limit: int = 2_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``limit`` rows, so that long texts stay few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, limit):
            yield batch.slice(start, limit)


def slices_of(
    batches: Iterator[pa.RecordBatch],
    texts: Callable[[pa.RecordBatch], pa.Array],
    rows: int = 2_000,
    size: int = 4_000_000,
) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows and ``size`` bytes of ``texts(batch)``.

    A row with a longer text is a slice of its own.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(texts(batch)), 0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        start = 0
        while start < batch.num_rows:
            fitting = int(np.searchsorted(ends, ends[start] + size, "right")) - 1
            stop = min(max(fitting, start + 1), start + rows, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def spread(values: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values (fixed multipliers of a public finalizer)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def map_arrow(
    df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` under one name, for the operators that work on Arrow batches."""
    return df.mapInArrow(step, schema)


def release_memory() -> None:
    """Gives what Arrow and the C library keep of freed memory back, as a Python process outlives its task."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()
