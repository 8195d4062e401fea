"""Row sampling."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_rows(df: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """A random share of the rows (by row, where the warehouse samples blocks)."""
    return df.sample(fraction, seed)


def sample_keys(df: DataFrame, key: str, fraction: float = 0.1) -> DataFrame:
    """The rows whose hexadecimal hash key lies in the first ``fraction`` of all keys.

    The same rows whatever the layout; rows with one key stay together, null keys go.
    """
    bound = f"{int(fraction * 16**8):09x}"
    return df.where(F.concat(F.lit("0"), F.left(key, F.lit(8))) < bound)
