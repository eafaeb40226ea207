from tidemark.sources.connector import connector_options, copy_query, read_query
from tidemark.sources.files import (
    load_directory,
    load_seed,
    read_checkpoint,
    read_headerless_csv,
    read_inferred_csv,
)
from tidemark.sources.samples import SampleTables
from tidemark.sources.tables import create_table, insert_rows, rows_frame, run_sql, table

__all__ = [
    "SampleTables", "connector_options", "copy_query", "create_table", "insert_rows",
    "load_directory", "load_seed", "read_checkpoint", "read_headerless_csv",
    "read_inferred_csv", "read_query", "rows_frame", "run_sql", "table",
]
