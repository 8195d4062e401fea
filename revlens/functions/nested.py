"""Safe access to arrays and to JSON text."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def element_or_null(array: Column, index: int) -> Column:
    """Zero-based element, null outside the array (also under ANSI)."""
    return F.get(array, F.lit(index))


def json_scalar(text: Column, path: str) -> Column:
    """The scalar at a JSON path as text; null for objects, arrays, null, bad JSON.

    The variant type tells a JSON null from the string "null", which
    ``get_json_object`` does not.
    """
    found = F.try_variant_get(F.try_parse_json(text), path, "variant")
    kind = F.schema_of_variant(found)
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    return F.when(~nested, F.try_variant_get(found, "$", "string"))
