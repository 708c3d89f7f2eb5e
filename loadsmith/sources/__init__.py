from loadsmith.sources.documents import (
    first_rows,
    flatten_array,
    nested_as_string,
    parse_column,
    parse_documents,
    read_documents,
    read_raw_documents,
    replace_in_text,
    rows_from_2d,
    to_name_value,
)
from loadsmith.sources.tables import empty_frame, read_or_empty, read_table

__all__ = [
    "first_rows", "flatten_array", "nested_as_string", "parse_column", "parse_documents",
    "read_documents", "read_raw_documents", "replace_in_text", "rows_from_2d", "to_name_value",
    "empty_frame", "read_or_empty", "read_table",
]
