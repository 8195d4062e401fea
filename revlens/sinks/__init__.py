"""Table writers: versioned rebuilds, month-partitioned fact, audit log."""

from revlens.sinks.audit import append_run, read_runs
from revlens.sinks.fact import expire_snapshots, merge_fact, read_fact, write_fact
from revlens.sinks.tables import create_namespace, merge_table, read_table, write_table

__all__ = [
    "append_run",
    "create_namespace",
    "expire_snapshots",
    "merge_fact",
    "merge_table",
    "read_fact",
    "read_runs",
    "read_table",
    "write_fact",
    "write_table",
]
