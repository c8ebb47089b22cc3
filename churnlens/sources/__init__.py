"""Scans: raw CSV, ORC tables, catalog DDL, and the order-derived fixture."""

from churnlens.sources.csv_quoted import line_width_report, read_quoted_csv, write_quoted_csv
from churnlens.sources.csv_raw import read_raw_csv, write_raw_csv
from churnlens.sources.fixture import raw_records
from churnlens.sources.tables import (
    create_database,
    declare_csv_table,
    declare_orc_table,
    describe_columns,
    describe_table,
    drop_table,
    set_location,
    table_location,
    use_database,
)

__all__ = [
    "create_database",
    "declare_csv_table",
    "declare_orc_table",
    "describe_columns",
    "describe_table",
    "drop_table",
    "line_width_report",
    "raw_records",
    "read_quoted_csv",
    "read_raw_csv",
    "set_location",
    "table_location",
    "use_database",
    "write_quoted_csv",
    "write_raw_csv",
]
