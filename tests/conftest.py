import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Where the tests run from a plain Python, DuckDB may live beside it.
sys.path.append("/opt/oracle")

from revlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        app="tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows and a schema string to a DataFrame."""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


@pytest.fixture
def column(frame):
    """Values of one column after an expression: ``column(type, values, expression)``."""
    from pyspark.sql import functions as F

    def run(dtype, values, expression):
        df = frame(f"i int, v {dtype}", *enumerate(values))
        rows = df.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
        return [row.r for row in rows]

    return run


@pytest.fixture
def conf(spark):
    changed = {}

    def set_all(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_all
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rows_of(df):
    """All rows as sorted tuples."""
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture
def rows():
    return rows_of
