from tallyloom.sources.files import (
    json_spec,
    read_csv,
    read_json,
    read_json_auto,
    read_json_lines,
    read_parquet,
    with_load_time,
)
from tallyloom.sources.freshness import freshness
from tallyloom.sources.generic import stage_generic, union_by_name
from tallyloom.sources.inventory import (
    column_profile,
    dataset_inventory,
    file_inventory,
    rows_per_file,
)
from tallyloom.sources.jdbc import attach_jdbc, jdbc_options, read_jdbc
from tallyloom.sources.sinks import (
    MONTH,
    publish_views,
    read_partitioned,
    with_month,
    write_partitioned,
)

__all__ = [
    "MONTH",
    "attach_jdbc",
    "column_profile",
    "dataset_inventory",
    "file_inventory",
    "freshness",
    "jdbc_options",
    "json_spec",
    "publish_views",
    "read_csv",
    "read_jdbc",
    "read_json",
    "read_json_auto",
    "read_json_lines",
    "read_parquet",
    "read_partitioned",
    "rows_per_file",
    "stage_generic",
    "union_by_name",
    "with_load_time",
    "with_month",
    "write_partitioned",
]
