"""The review fact on disk: month versions behind one manifest, files clustered by product.

A month's rows lie in the folder of the version that wrote them. A manifest names the version
of every month; readers take the newest one and so see a table before or after a merge, never
between. Nothing a manifest names is changed or removed until ``expire_snapshots``.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from revlens.functions import month_start
from revlens.operators.merge import merge_upsert
from revlens.session import scratch_path
from revlens.sinks.tables import (
    COMMIT_MARKER,
    list_names,
    path_exists,
    read_note,
    register_fact,
    remove_folder,
    rename_new,
    write_note,
)

MONTH = "review_month"
CLUSTER = ("product_id", "reviewer_id")
# Folder levels below ``data``.
VERSION, PART = "version", "file_part"
SNAPSHOTS = "_snapshots"

# Rows from which a month is cut into several product ranges, and how many at most (a bigger
# range is split by size, not by product).
FILE_ROWS, MAX_PARTS = 2_000_000, 64
# Bytes of a product id that its place among the quantiles is judged by.
PREFIX_BYTES = 7


class ConcurrentMerge(RuntimeError):
    """Another writer published a snapshot since this one was begun."""


def with_month(fact: DataFrame) -> DataFrame:
    return fact.withColumn(MONTH, month_start(F.col("review_date")))


# --- product ranges -------------------------------------------------------------------


def _place(product: Column) -> Column:
    """The first bytes of a product id as a number that keeps their order."""
    head = F.hex(F.substring(product.cast("binary"), 1, PREFIX_BYTES))
    return F.conv(F.rpad(head, 2 * PREFIX_BYTES, "0"), 16, 10).cast("bigint")


def product_ranges(narrow: DataFrame, file_rows: int = FILE_ROWS) -> DataFrame:
    """Rows (month, cuts): the bounds that part a month's products into ranges of ``file_rows``.

    ``narrow`` holds month and product of what will be written, so the scan behind it reads
    two columns. Quantiles are kept as sketches per task; a month is one small row.
    """
    steps = [i / MAX_PARTS for i in range(1, MAX_PARTS)]
    months = narrow.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx(_place(F.col("product_id")), steps).alias("_q"),
    )
    parts = F.least(F.ceil(F.col("_n") / file_rows), F.lit(MAX_PARTS)).cast("int")
    picked = F.transform(
        F.sequence(F.lit(1), F.greatest(parts - 1, F.lit(1))),
        lambda i: F.element_at("_q", F.greatest(F.floor(i * MAX_PARTS / parts), F.lit(1)).cast("int")),
    )
    none = F.array().cast("array<bigint>")
    return months.select(
        MONTH, F.when(parts > 1, F.coalesce(F.array_distinct(picked), none)).otherwise(none).alias("_cuts")
    )


def _with_part(fact: DataFrame, ranges: DataFrame | None) -> DataFrame:
    if ranges is None:
        return fact.withColumn(PART, F.lit(0))
    # One row per calendar month of the years 1 to 9999 at most, so a broadcast is bounded.
    part = F.size(F.filter("_cuts", lambda cut: cut < F.col("_place")))
    return (
        fact.withColumn("_place", _place(F.col("product_id")))
        .join(F.broadcast(ranges), MONTH, "left")
        .withColumn(PART, F.coalesce(F.when(F.col("_place").isNotNull(), part), F.lit(0)))
        .drop("_place", "_cuts")
    )


# --- snapshots ------------------------------------------------------------------------


def _manifest(path: str, number: int) -> str:
    return f"{path}/{SNAPSHOTS}/s{number:08d}.json"


def snapshots(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published snapshots, ascending."""
    names = list_names(spark, f"{path}/{SNAPSHOTS}")
    return sorted(int(n[1:-5]) for n in names if n.startswith("s") and n.endswith(".json"))


def _read_manifest(spark: SparkSession, path: str, number: int) -> dict:
    return json.loads(read_note(spark, _manifest(path, number)))


def _publish(spark: SparkSession, path: str, number: int, manifest: dict) -> None:
    """Make a snapshot visible under its number by renaming a finished file to it."""
    draft = f"{path}/{SNAPSHOTS}/_draft-{uuid.uuid4().hex}"
    write_note(spark, draft, json.dumps(manifest))
    try:
        rename_new(spark, draft, _manifest(path, number))
    except Exception as failure:
        if path_exists(spark, _manifest(path, number)):
            raise ConcurrentMerge(f"snapshot {number} of {path} is already there") from failure
        raise


def _next_version(spark: SparkSession, path: str) -> int:
    """A version folder no job has used, published or lost."""
    used = [int(n.split("=")[1]) for n in list_names(spark, f"{path}/data") if n.startswith(VERSION)]
    return max(used, default=0) + 1


def _write_version(
    fact: DataFrame, ranges: DataFrame | None, path: str, columns: list[Column | str] | None = None
) -> dict[str, int]:
    """Write the rows (with their month) into a new version; folder names of months to version."""
    spark = fact.sparkSession
    version = _next_version(spark, path)
    target = f"{path}/data/{VERSION}={version}"
    # Rebalancing gives a task whole (month, range) groups: adaptive execution merges small
    # ones and cuts one that is too big into slices of the map output, even copies of a row.
    spread = _with_part(fact, ranges).hint("rebalance", MONTH, PART)
    (
        (spread.select(*columns, MONTH, PART) if columns else spread)
        .sortWithinPartitions(MONTH, PART, *CLUSTER)
        .write.partitionBy(MONTH, PART)
        .parquet(target)
    )
    return {name: version for name in list_names(spark, target) if name.startswith(MONTH)}


def _schema(fact: DataFrame) -> dict:
    columns = [f for f in fact.schema if f.name not in (MONTH, PART, VERSION)]
    return json.loads(StructType(columns).json())


def write_fact(
    fact: DataFrame, path: str, file_rows: int | None = None, columns: list[Column | str] | None = None
) -> None:
    """Replace the table by these rows; older snapshots stay readable.

    With ``file_rows`` a month is cut into product ranges of about so many rows. That scans
    month and product of ``fact`` beforehand: cheap on stored tables, not where the frame
    behind them is costly to derive. ``columns`` are those to be stored, if they are to be made
    only after the rows were shuffled; ``fact`` then needs date, product and reviewer for its order.
    """
    spark = fact.sparkSession
    published = snapshots(spark, path)
    monthly = with_month(fact)
    ranges = file_rows and product_ranges(monthly.select(MONTH, "product_id"), file_rows)
    months = _write_version(monthly, ranges, path, columns)
    number = published[-1] + 1 if published else 1
    schema = _schema(fact.select(*columns) if columns else fact)
    _publish(spark, path, number, {"months": months, "schema": schema})


def has_fact(spark: SparkSession, path: str) -> bool:
    """Whether a fact table was published.

    Tables from before the manifests are refused, as a new one beside them would hide rows.
    """
    if snapshots(spark, path):
        return True
    if path_exists(spark, f"{path}/{COMMIT_MARKER}") or path_exists(spark, f"{path}/_SUCCESS"):
        raise RuntimeError(f"{path} has no snapshots: read its parquet files and rewrite it with write_fact")
    return False


def read_fact(
    spark: SparkSession, path: str, since: dt.date | None = None, snapshot: int | None = None
) -> DataFrame:
    """The fact rows of the newest (or a given) snapshot.

    ``since`` leaves out older months, then filters the days. The months are fixed when the
    frame is defined; merges that follow do not touch its files.
    """
    fact = read_months(spark, path, snapshot)
    if since is not None:
        fact = fact.where(
            (F.col(MONTH) >= F.lit(since.replace(day=1))) & (F.col("review_date") >= F.lit(since))
        )
    return fact.drop(MONTH)


def read_months(
    spark: SparkSession, path: str, snapshot: int | None = None, months: list[dt.date] | None = None
) -> DataFrame:
    """The rows of a snapshot with their month, all months or those given."""
    published = snapshots(spark, path)
    if not published:
        raise FileNotFoundError(f"no published snapshot below {path}")
    manifest = _read_manifest(spark, path, snapshot or published[-1])
    schema = StructType.fromJson(manifest["schema"])
    wanted = None if months is None else {f"{MONTH}={month}" for month in months}
    folders = [
        f"{path}/data/{VERSION}={version}/{name}"
        for name, version in sorted(manifest["months"].items())
        if wanted is None or name in wanted
    ]
    if not folders:
        return spark.createDataFrame([], StructType([*schema, StructField(MONTH, DateType())]))
    versions = set(manifest["months"].values())
    if wanted is None and len(versions) == 1:
        # All that one version wrote: one folder to list.
        folders = [f"{path}/data/{VERSION}={versions.pop()}"]
    levels = [(VERSION, IntegerType()), (MONTH, DateType()), (PART, IntegerType())]
    stored = StructType([*schema, *[StructField(name, kind) for name, kind in levels]])
    fact = spark.read.schema(stored).option("basePath", f"{path}/data").parquet(*folders)
    return fact.drop(VERSION, PART)


def register_snapshot(spark: SparkSession, path: str, namespace: str, name: str) -> None:
    """Let queries read the newest snapshot by a catalog name; to be called after each merge."""
    manifest = _read_manifest(spark, path, snapshots(spark, path)[-1])
    months = [f"{path}/data/{VERSION}={v}/{month}" for month, v in sorted(manifest["months"].items())]
    folders = [f"{m}/{part}" for m in months for part in list_names(spark, m) if part.startswith(PART)]
    levels = [StructField(MONTH, DateType()), StructField(PART, IntegerType())]
    register_fact(spark, namespace, name, folders, StructType([*StructType.fromJson(manifest["schema"]), *levels]))


def merge_fact(source: DataFrame, path: str, file_rows: int = FILE_ROWS) -> None:
    """Merge rows on ``review_sk``, writing each month they fall in once.

    The key contains the review time, so a row never changes its month and the other months
    cannot hold a match. The merged months go to a new version; the snapshot that names it
    appears whole. A job that is lost before leaves a version nobody reads, and a second
    writer on the same table fails with ``ConcurrentMerge`` instead of losing rows.
    """
    spark = source.sparkSession
    incoming_dir = scratch_path(spark, "fact-incoming")
    with_month(source).write.parquet(incoming_dir)
    incoming = spark.read.parquet(incoming_dir)
    # At most one row per calendar month, whatever the size of the data.
    months = [row[0] for row in incoming.select(MONTH).distinct().collect()]
    if not months:
        return
    number = snapshots(spark, path)[-1]
    manifest = _read_manifest(spark, path, number)
    touched = read_months(spark, path, number, months)
    incoming = incoming.select(touched.columns)
    narrow = touched.select(MONTH, "product_id").unionByName(incoming.select(MONTH, "product_id"))
    merged = merge_upsert(touched, incoming, "review_sk")
    written = _write_version(merged, product_ranges(narrow, file_rows), path)
    _publish(spark, path, number + 1, manifest | {"months": manifest["months"] | written})


def expire_snapshots(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Forget all but the newest ``keep`` snapshots; returns how many month folders went.

    Folders go that no kept snapshot names, also those of lost jobs. Versions newer than the
    newest snapshot are left alone, as a running merge may be writing them. Readers of a
    forgotten snapshot fail, so keep as many as the longest query needs.
    """
    published = snapshots(spark, path)
    kept = [_read_manifest(spark, path, n)["months"] for n in published[-keep:]]
    newest = max((v for months in kept for v in months.values()), default=0)
    named = {(name, version) for months in kept for name, version in months.items()}
    for number in published[:-keep]:
        remove_folder(spark, _manifest(path, number))
    removed = 0
    for folder in list_names(spark, f"{path}/data"):
        version = int(folder.split("=")[1]) if folder.startswith(f"{VERSION}=") else newest + 1
        if version > newest:
            continue
        for name in list_names(spark, f"{path}/data/{folder}"):
            if name.startswith(MONTH) and (name, version) not in named:
                remove_folder(spark, f"{path}/data/{folder}/{name}")
                removed += 1
    return removed
