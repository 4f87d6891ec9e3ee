"""Exact pages of a table in key order, without a one-partition window.

``page`` numbers every row by its position in key order and puts row *i* in
page ``floor(i / batch_size)``: pages are disjoint, cover the table and hold
exactly ``batch_size`` rows (the last one the rest), which is what ``LIMIT i*BS, BS``
meant, but without the missing ORDER BY.

Plan (every step distributed; the driver sees one row per range partition):

1. rows are range-partitioned by ``(key, row hash)`` in the key's own type, into
   ``ceil(rows / rows_per_bucket)`` partitions, and sorted inside; of more than ``FEW_BUCKETS``,
   each holds ``ROWS_OF_A_TASK`` rows at least, however few are asked for. The bounds are sampled
   from the rows; as the hash is a part of the order, a key value (or NULL)
   that holds a third of the table is split over as many partitions as it fills.
   Any orderable key works: big integers, wide decimals, dates, text;
2. the sorted rows are checkpointed with their partition and place, so the source is
   read once and offsets and rows come from the same state, also after a lost executor;
3. rows per partition → running offsets (a window over those few rows),
   broadcast back; the position is the offset plus the place.

``page_slice`` sorts no more than its page: ``selection`` finds the interval of the order that holds it.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.lists import key_list
from tidemark.operators.selection import selectable, select_range
from tidemark.session import checkpoint_dir

SPARE_ROWS = 10_000  # that a selection may hold beside its page
DEFAULT_ROWS_PER_BUCKET = 4_000_000
FEW_BUCKETS = 64  # up to so many partitions are as small as asked for
ROWS_OF_A_TASK = 250_000  # beyond that: samples, tasks and files grow with the rows, not with rows / rows_per_bucket
_PLACE_BITS = (1 << 33) - 1  # monotonically_increasing_id holds the place in its low 33 bits


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(_q(c)) for c in df.columns])


def n_buckets(n_rows: int, rows_per_bucket: int) -> int:
    """Range partitions for so many rows."""
    asked = math.ceil(n_rows / max(1, rows_per_bucket))
    return max(1, min(asked, max(FEW_BUCKETS, math.ceil(n_rows / ROWS_OF_A_TASK))))


def positions(rows: DataFrame, key: str, rows_per_bucket: int) -> DataFrame:
    """``rows`` (with a hash column ``_h``) plus ``_p``, ``_i`` (partition and place in it) and ``_offset``."""
    spark = rows.sparkSession
    n = n_buckets(rows.count(), rows_per_bucket)
    order = [F.col(_q(key)).asc_nulls_first(), F.col("_h").asc()]
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    placed = (rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_p", F.spark_partition_id())
              .withColumn("_i", F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_BITS))).checkpoint())
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition: a proven bound, safe to broadcast
    offsets = (placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
               .select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("bigint").alias("_offset")))
    return placed.join(F.broadcast(offsets), "_p")


def page(df: DataFrame, key: str, batch_size: int, *, rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
         batch_col: str = "batch_id", index_col: str = "row_index") -> DataFrame:
    """Add ``row_index`` (0-based position in key order, NULLs first) and ``batch_id``."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    placed = positions(df.withColumn("_h", row_hash(df)), key, rows_per_bucket)
    index = (F.col("_offset") + F.col("_i")).cast("bigint")
    return placed.select(*[F.col(_q(c)) for c in df.columns], index.alias(index_col),
                         F.floor(index / F.lit(batch_size)).cast("bigint").alias(batch_col))


def page_slice(df: DataFrame, key: str, batch_size: int, batch_id: int, *,
               rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET, batch_col: str = "batch_id",
               index_col: str = "row_index") -> DataFrame:
    """Rows of one page (the ``LIMIT offset, n`` of one batch).

    Range histograms find an interval that holds the page and little more; only its rows are read
    whole, shuffled and sorted. Keys whose order no bin follows (floats, booleans, binary, nested) are sorted as in ``page``."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    first, last = batch_id * batch_size, (batch_id + 1) * batch_size - 1
    out = [F.col(_q(c)) for c in df.columns]
    if not selectable(df.schema[key].dataType):
        paged = page(df, key, batch_size, rows_per_bucket=rows_per_bucket, batch_col=batch_col, index_col=index_col)
        return paged.where(F.col(batch_col) == batch_id)
    found = select_range(df, key, row_hash(df), first, last, 2 * batch_size + SPARE_ROWS)
    if found is None:
        return df.where(F.lit(False)).select(*out, F.lit(0).cast("bigint").alias(index_col), F.lit(batch_id).cast("bigint").alias(batch_col))
    rows = df.where(found.condition).withColumn("_h", row_hash(df))
    if found.n <= rows_per_bucket:  # one sorted partition holds them
        order = Window.orderBy(F.col(_q(key)).asc_nulls_first(), F.col("_h").asc())
        placed, at = rows, F.row_number().over(order) - 1
    else:
        placed, at = positions(rows, key, rows_per_bucket), F.col("_offset") + F.col("_i")
    index = (at + F.lit(found.before)).cast("bigint")
    return (placed.withColumn(index_col, index).where(F.col(index_col).between(first, last))
            .select(*out, index_col, F.lit(batch_id).cast("bigint").alias(batch_col)))


def hash_batches(df: DataFrame, keys: str | Iterable[str], n_batches: int, batch_col: str = "batch_id") -> DataFrame:
    """Disjoint, complete batches by key hash (sizes only roughly equal)."""
    ks = key_list(keys)
    return df.withColumn(batch_col, F.pmod(F.xxhash64(*[F.col(_q(k)) for k in ks]), F.lit(n_batches)))
