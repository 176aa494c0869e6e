"""Raw-layer inputs: delimited text under declared schemas, Parquet, catalog."""

from strata.sources.delimited import (
    as_raw_text, read_delimited, read_raw_tables, source_path, write_delimited,
)
from strata.sources.tables import read_catalog_table, read_parquet_sources, read_parquet_table

__all__ = [
    "as_raw_text", "read_delimited", "read_raw_tables", "source_path", "write_delimited",
    "read_catalog_table", "read_parquet_sources", "read_parquet_table",
]
