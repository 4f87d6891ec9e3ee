"""tidemark — watermark-driven table loading on Spark.

A control table says which tables are due; each due table is read (JDBC or
files), sliced by its time columns, renamed, checked for key uniqueness and
brought up to date in its target by key (merge, stage-and-swap, delete).
All work on table rows is expressed with the DataFrame API so it runs on the
executors; only the schedule (one row per table) ever reaches the driver.
"""

from tidemark.session import local_session, shared_dir  # noqa: F401

__all__ = ["local_session", "shared_dir"]
