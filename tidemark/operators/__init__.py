"""Row-level operators on DataFrames (filters, key checks, upserts, paging)."""

from tidemark.operators.columns import rename_columns  # noqa: F401
from tidemark.operators.counts import batch_plan, row_counts  # noqa: F401
from tidemark.operators.incremental import incremental_filter, incremental_join, zero_dates_to_null  # noqa: F401
from tidemark.operators.keys import distinct_keys, duplicate_keys, unique_check, unique_check_many  # noqa: F401
from tidemark.operators.paging import hash_batches, page, page_slice  # noqa: F401
from tidemark.operators.upsert import (  # noqa: F401
    MergeAmbiguityError,
    ambiguous_target_rows,
    delete_by_keys,
    matched_by_keys,
    merge_metrics,
    merge_upsert,
    stage_swap,
)
