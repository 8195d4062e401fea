"""Hash keys over several columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stored keys are only comparable if both stay as they are.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*columns: Column | str) -> Column:
    """md5 over the columns' text joined by ``-``, nulls replaced by a token."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_TOKEN))
        for c in columns
    ]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
