"""Writing catalog tables."""

from daybook.sinks.tables import (
    TableWriteError,
    write_compact,
    write_partitioned,
    write_table,
    write_typed,
    write_typed_partitioned,
)

__all__ = [
    "TableWriteError",
    "write_compact",
    "write_partitioned",
    "write_table",
    "write_typed",
    "write_typed_partitioned",
]
