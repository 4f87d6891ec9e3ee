"""Continuous incremental loads with Structured Streaming.

New source files (or any streaming source) are applied to a keyed lake table
micro-batch by micro-batch with ``foreachBatch``: each batch is a MERGE
(``upsert_lake``) or a stage-and-swap (``swap_lake``) that rewrites only the
buckets the batch touches, or (``as_delta``) writes the batch as a delta of the table.
Replaying a batch after a failure leaves the table as one application would, so the checkpoint's
at-least-once replay gives an effectively-once table: a delta carries the checkpoint and the batch's number
and is not committed twice; without deltas a batch with NULL keys, which never match and would be
inserted again, is refused.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions.lists import key_list
from tidemark.operators.incremental import incremental_filter
from tidemark.sinks.lake import swap_lake, upsert_lake


def file_stream(spark: SparkSession, landing_dir: str, schema: StructType, *, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, time_cols: str | Iterable[str] | None = None,
                watermark: str | None = None, unit: str = "s", tz: str = "UTC") -> DataFrame:
    """Stream the files arriving in ``landing_dir``; optionally keep only the time slice."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load(landing_dir)
    if time_cols is not None and watermark is not None:
        df = incremental_filter(df, time_cols, watermark, unit, tz=tz)
    return df


def upsert_stream(stream: DataFrame, path: str, keys: str | Iterable[str], checkpoint_location: str, *,
                  mode: str = "merge", as_delta: bool = False, create: bool = False, n_buckets: int | None = None, fmt: str = "parquet",
                  available_now: bool = False, processing_time: str | None = None,
                  query_name: str | None = None) -> StreamingQuery:
    """Apply every micro-batch of ``stream`` to the keyed lake table at ``path``.

    The table must exist unless ``create=True`` (a stream that starts with all rows)."""
    ks = key_list(keys)
    if mode not in ("merge", "swap"):
        raise ValueError("mode must be 'merge' or 'swap'")

    def apply(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        sink = upsert_lake if mode == "merge" else swap_lake
        sink(spark, batch, path, ks, create=create, n_buckets=n_buckets, fmt=fmt, as_delta=as_delta, refuse_null_keys=True,
             tag=f"{checkpoint_location}#{epoch_id}")

    w = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_location)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
