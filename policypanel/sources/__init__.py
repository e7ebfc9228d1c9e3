"""Sources: CSV readers with explicit schemas, drifted yearly extracts, tables."""

from policypanel.sources.csv import (
    clean_header,
    normalise_header,
    read_csv,
    read_yearly,
    resolve_header,
    split_rejects,
)
from policypanel.sources.tables import inline_table, parquet_table, scan_table

__all__ = ["clean_header", "inline_table", "normalise_header", "parquet_table", "read_csv",
           "read_yearly", "resolve_header", "scan_table", "split_rejects"]
