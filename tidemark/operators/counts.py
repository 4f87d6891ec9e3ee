"""Row counts and the huge-table batch plan.

``row_counts`` counts many tables in one job (a union of global counts; each
count is a partial aggregate per task). It replaces reading a row count from
optimizer statistics, which is missing for plain file tables.

``batch_plan`` decides how a table is moved: tables with more rows than the
threshold go in ``ceil(rows / batch_size)`` pages, the others in one piece
(``n_batches = 0``).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The job's huge-table threshold and page size (rows).
HUGE_TABLE_ROWS = 5_000_000
PAGE_ROWS = 1_000_000


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
             .select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def batch_plan(counts: DataFrame, threshold: int = HUGE_TABLE_ROWS, batch_size: int = PAGE_ROWS,
               rows_col: str = "n_rows") -> DataFrame:
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    n = F.col(rows_col)
    huge = n > F.lit(threshold)
    return counts.withColumns({
        "is_huge": huge,
        "n_batches": F.when(huge, F.ceil(n / F.lit(batch_size))).otherwise(F.lit(0)).cast("bigint"),
    })
