"""Sources: files (parquet/csv/…), lake tables and JDBC databases."""

from tidemark.sources.files import read_table  # noqa: F401
