"""Text scans, record cleaning and landing loads."""

from revlens.sources.landing import (
    BadRecordBudgetExceeded,
    enforce_budget,
    infer_schema,
    load_landing,
    load_lines,
    load_table,
    parse_ndjson,
)
from revlens.sources.lines import (
    decompress,
    normalize_lines,
    read_lines,
    require_utf8,
)
from revlens.sources.records import (
    bad_record_report,
    clean_file,
    canonical_records,
    clean_records,
    is_strict_json,
    rejected_lines,
)

__all__ = [
    "BadRecordBudgetExceeded",
    "bad_record_report",
    "canonical_records",
    "clean_file",
    "clean_records",
    "decompress",
    "enforce_budget",
    "infer_schema",
    "is_strict_json",
    "load_landing",
    "load_lines",
    "load_table",
    "normalize_lines",
    "parse_ndjson",
    "read_lines",
    "rejected_lines",
    "require_utf8",
]
