"""Reading catalog tables."""

from daybook.sources.tables import (
    TableReadError,
    check_table_name,
    scan_columns,
    scan_table,
    scan_typed,
)

__all__ = [
    "TableReadError",
    "check_table_name",
    "scan_columns",
    "scan_table",
    "scan_typed",
]
