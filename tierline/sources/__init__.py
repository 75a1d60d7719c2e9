"""Sources and sinks (CSV scans with declared schemas, table I/O, CSV export)."""

from tierline.sources.tables import (
    DEFAULT_FORMAT,
    export_csv,
    read_csv,
    read_csv_inferred,
    read_table,
    show_table,
    write_table,
)

__all__ = [
    "DEFAULT_FORMAT",
    "export_csv",
    "read_csv",
    "read_csv_inferred",
    "read_table",
    "show_table",
    "write_table",
]
