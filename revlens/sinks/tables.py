"""Full-rebuild tables as parquet versions.

Parquet has no MERGE and a table cannot be overwritten by a plan that reads it.
So each write goes to a new version folder and counts once an empty marker file
lies in it; readers take the newest marked version. A write that dies leaves an
unmarked folder that nobody reads.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revlens.operators.merge import merge_whole

COMMIT_MARKER = "_COMMITTED"

# A version may hold rejected rows beside its own, in a partition that readers skip.
IS_BAD, REJECTED = "is_bad", "rejected_record"


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _hadoop_path(spark, path)
    return fs.exists(target)


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small file next to table data (readers skip names that start with ``_``)."""
    target, fs = _hadoop_path(spark, path)
    stream = fs.create(target, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_note(spark: SparkSession, path: str) -> str | None:
    target, fs = _hadoop_path(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    text = spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    stream.close()
    return bytes(text).decode()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    target, fs = _hadoop_path(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]


def rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file to a name that is not taken; an error if it is."""
    jvm = spark._jvm.org.apache.hadoop.fs
    context = jvm.FileContext.getFileContext(
        jvm.Path(source).toUri(), spark._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 0)
    context.rename(jvm.Path(source), jvm.Path(target), options)


def make_folder(spark: SparkSession, path: str) -> None:
    target, fs = _hadoop_path(spark, path)
    fs.mkdirs(target)


def remove_folder(spark: SparkSession, path: str) -> None:
    target, fs = _hadoop_path(spark, path)
    fs.delete(target, True)


def _versions(spark: SparkSession, table_dir: str, pattern: str) -> list[str]:
    glob, fs = _hadoop_path(spark, f"{table_dir}/{pattern}")
    return sorted(status.getPath().toString() for status in fs.globStatus(glob) or [])


def current_version(spark: SparkSession, table_dir: str) -> str | None:
    """Folder of the newest committed version, or None."""
    marked = _versions(spark, table_dir, f"v*/{COMMIT_MARKER}")
    return marked[-1].rsplit("/", 1)[0] if marked else None


def stage_version(df: DataFrame, table_dir: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write the rows as the next version without publishing it."""
    taken = _versions(df.sparkSession, table_dir, "v*")
    number = int(taken[-1].rsplit("/v", 1)[1]) + 1 if taken else 1
    path = f"{table_dir}/v{number:08d}"
    with unsorted_writers(df.sparkSession):
        df.write.partitionBy(*partition_by).parquet(path)
    return path


@contextmanager
def unsorted_writers(spark: SparkSession, files: int = 4) -> Iterator[None]:
    """Within, a task writes a few partitions side by side instead of sorting its rows by them."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(files))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def commit_version(
    spark: SparkSession, table_dir: str, path: str, split: DataFrame | None = None
) -> None:
    """Publish a staged version; ``split`` is its frame if it holds rejected rows too."""
    write_note(spark, f"{path}/{COMMIT_MARKER}", split.schema.json() if split is not None else "")


def write_table(df: DataFrame, table_dir: str) -> None:
    """Replace the table's content."""
    commit_version(df.sparkSession, table_dir, stage_version(df, table_dir))


def _stored(spark: SparkSession, table_dir: str, bad: bool) -> DataFrame | None:
    path = current_version(spark, table_dir)
    if path is None:
        raise FileNotFoundError(f"no committed version below {table_dir}")
    schema = read_note(spark, f"{path}/{COMMIT_MARKER}")
    if not schema:
        return None if bad else spark.read.parquet(path)
    rows = spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(path)
    return rows.where(F.col(IS_BAD) == bad).drop(IS_BAD)


def read_table(spark: SparkSession, table_dir: str) -> DataFrame:
    """The table's committed content."""
    return _stored(spark, table_dir, False).drop(REJECTED)


def rejected_records(spark: SparkSession, table_dir: str) -> DataFrame:
    """Lines that the table's load rejected, with place (if known) and reason."""
    rows = _stored(spark, table_dir, True)
    if rows is None:
        return spark.createDataFrame([], "line string, reason string")
    return rows.select(f"{REJECTED}.*")


def merge_table(
    source: DataFrame,
    table_dir: str,
    key: str,
    update_columns: list[str] | None = None,
) -> None:
    """Merge a full set of rows into a versioned table; the first run creates it."""
    spark = source.sparkSession
    if current_version(spark, table_dir) is None:
        return write_table(source, table_dir)
    return write_table(merge_whole(read_table(spark, table_dir), source, key, update_columns), table_dir)


def create_namespace(spark: SparkSession, name: str) -> None:
    """Create a catalog namespace unless it is there."""
    spark.sql("CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:name)", args={"name": name})


def register_table(spark: SparkSession, namespace: str, name: str, table_dir: str) -> None:
    """Make a versioned table's newest version known to the catalog, as a view."""
    path = current_version(spark, table_dir)
    columns = ", ".join(_quoted(c) for c in read_table(spark, table_dir).columns)
    where = f" WHERE NOT {IS_BAD}" if read_note(spark, f"{path}/{COMMIT_MARKER}") else ""
    spark.sql(
        f"CREATE OR REPLACE VIEW {_quoted(namespace)}.{_quoted(name)} "
        f"AS SELECT {columns} FROM parquet.{_quoted(path)}{where}"
    )


def register_fact(spark: SparkSession, namespace: str, name: str, folders: list[str], schema: StructType) -> None:
    """Make the files of a snapshot known to the catalog: an external table and a view of it.

    ``folders`` end in a month and a file part, the table's partitions; ``schema`` has both last.
    """
    files = f"{_quoted(namespace)}.{_quoted(name + '_files')}"
    levels = [f.name for f in schema][-2:]
    spark.sql(f"DROP TABLE IF EXISTS {files}")
    if folders:
        root = folders[0].rsplit("/", 3)[0]
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE {files} ({columns}) USING parquet PARTITIONED BY ({', '.join(levels)}) LOCATION '{root}'")
        parts = [dict(part.split("=") for part in folder.rsplit("/", 2)[1:]) for folder in folders]
        added = " ".join(
            f"PARTITION ({', '.join(f'{level} = {part[level]!r}' for level in levels)}) LOCATION '{folder}'"
            for part, folder in zip(parts, folders)
        )
        spark.sql(f"ALTER TABLE {files} ADD IF NOT EXISTS {added}")
        names = ", ".join(_quoted(f.name) for f in schema if f.name not in levels)
        spark.sql(f"CREATE OR REPLACE VIEW {_quoted(namespace)}.{_quoted(name)} AS SELECT {names} FROM {files}")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
