"""Reading and writing of tables."""
from pavilion.sources.reader import (
    FAILURES, UNREADABLE, as_text, cast_losses, load_tables, read_table, register_views, row_counts, typed,
)
from pavilion.sources.schemas import SCHEMAS, cleaned_schema, schema_differences
from pavilion.sources.writer import replaced, write_table

__all__ = [
    "FAILURES", "SCHEMAS", "UNREADABLE", "as_text", "cast_losses", "cleaned_schema", "load_tables", "read_table",
    "register_views", "replaced", "row_counts", "schema_differences", "typed", "write_table",
]
