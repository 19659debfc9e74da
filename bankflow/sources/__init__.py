from bankflow.sources.bucketed import BucketedTable, MergeCounts
from bankflow.sources.files import (
    load_payloads,
    read_checked_json,
    read_csv_staging,
    read_json_lines,
    read_nested_json,
)
from bankflow.sources.jdbc import (
    bounds_query,
    increment_condition,
    partition_options,
    probe_bounds,
    read_partitioned,
    scan_query,
)
from bankflow.sources.sinks import append_table, create_if_absent, overwrite_table, save_table
from bankflow.sources.snapshots import SnapshotTable

__all__ = [
    "BucketedTable", "MergeCounts", "SnapshotTable", "append_table", "bounds_query", "create_if_absent",
    "increment_condition", "load_payloads", "overwrite_table", "partition_options", "probe_bounds", "read_checked_json",
    "read_csv_staging", "read_json_lines", "read_nested_json", "read_partitioned", "save_table", "scan_query",
]
