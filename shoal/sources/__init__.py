"""Landing readers (group A): CSV, JSON, Parquet, text, tables, JDBC — always with an explicit schema."""

from shoal.sources.files import (
    CORRUPT, cast_table, numbered_lines, read_csv_landing, read_csv_numbered, read_csv_typed, read_csv_with_rejects, read_json_documents,
    read_json_lines, read_parquet, read_table, read_text_lines, split_packed_list, text_schema,
)
from shoal.sources.jdbc import read_jdbc, write_jdbc

__all__ = [
    "CORRUPT", "cast_table", "numbered_lines", "read_csv_numbered", "read_csv_landing", "read_csv_typed", "read_csv_with_rejects",
    "read_json_documents", "read_json_lines", "read_jdbc", "read_parquet", "read_table",
    "read_text_lines", "split_packed_list", "text_schema", "write_jdbc",
]
