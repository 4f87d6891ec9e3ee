"""Sinks: keyed lake tables (files) and JDBC warehouses."""

from tidemark.sinks.lake import delete_from_lake, overwrite_lake, read_lake, swap_lake, upsert_lake  # noqa: F401
