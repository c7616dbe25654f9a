"""Where data is read from and written to: CSV snapshots, tables, the report, the layout."""

from txlake.sources.csv_files import land_snapshot, read_csv_strings, write_csv_strings
from txlake.sources.layout import Layout
from txlake.sources.scratch import scratch_dir
from txlake.sources.tables import (
    SchemaDriftError,
    drop_partitions,
    overwrite_table,
    partition_values,
    read_partitions,
    read_table,
    rebalance,
    reconcile,
    stored_schema,
    table_exists,
    write_json,
    write_partitions,
)
from txlake.sources.versions import VersionError, publish, publish_table, versions

__all__ = [
    "Layout",
    "SchemaDriftError",
    "VersionError",
    "drop_partitions",
    "land_snapshot",
    "overwrite_table",
    "partition_values",
    "publish",
    "publish_table",
    "read_csv_strings",
    "read_partitions",
    "read_table",
    "rebalance",
    "reconcile",
    "scratch_dir",
    "stored_schema",
    "table_exists",
    "versions",
    "write_csv_strings",
    "write_json",
    "write_partitions",
]
