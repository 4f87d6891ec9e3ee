"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared ``spark.checkpoint.dir`` and cut its lineage."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint(eager=True)


def slices(batch: pa.RecordBatch, max_rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Small pieces of an Arrow batch, so that few texts are Python objects at a time."""
    for i in range(0, batch.num_rows, max_rows):
        yield batch.slice(i, max_rows)


def text_slices(batch: pa.RecordBatch, column: int, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of an Arrow batch with at most ``most_bytes`` of text each (one row at least)."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).cumsum()
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, before + most_bytes, side="right")))
        yield batch.slice(at, to - at)
        at = to


def texts(column: pa.Array) -> list[str]:
    """Strings of an Arrow column, null as the empty text."""
    return [x or "" for x in column.to_pylist()]


class Memo(dict):
    """Cache of ``make(key)`` in two generations, so it holds at most 2 x ``limit`` entries.

    Used per Python worker: frequent keys are carried over when the young
    generation is full, rare ones are forgotten.
    """

    def __init__(self, make: Callable, limit: int = 200_000, longest: int = 64):
        super().__init__()
        self._make, self._limit, self._longest, self._old = make, limit, longest, {}

    def turn(self) -> None:
        """Start a new generation when the young one is full."""
        if len(self) >= self._limit:
            self._old = dict(self)
            self.clear()

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
        if len(key) <= self._longest:
            self[key] = value
        return value


def tree_merge(partials: DataFrame, merge: Callable[[bytes | None, bytes], bytes], fan: int = 32) -> DataFrame:
    """Merge ``(part int, payload binary)`` rows to one row per part, in two levels.

    ``merge(accumulated or None, payload)`` must be associative and commutative.
    Rows are streamed: a task holds one accumulated payload for each of its
    parts, however many partial payloads there are.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, bytes] = {}
        for batch in batches:
            for part, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held[part] = merge(held.get(part), payload.as_py())
        for part, payload in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([payload], pa.binary())],
                                             names=["part", "payload"])

    first = (partials.withColumn("_lane", F.pmod(F.spark_partition_id(), F.lit(fan)))
             .repartition(F.col("part"), F.col("_lane")).select("part", "payload")
             .mapInArrow(fold, "part int, payload binary"))
    return first.repartition(F.col("part")).mapInArrow(fold, "part int, payload binary")


def lanes_of_key(rows: DataFrame, key: str, lane_by: str, aggregates: list, facts: Callable[[], list],
                 lanes: int = 256) -> DataFrame:
    """Join per-key facts back onto the rows of ``key`` without a hot key landing in one task.

    Rows get a lane (a hash of ``lane_by``); ``aggregates`` are taken per (key, lane)
    and again per key by ``facts`` (a function giving the second-level columns), and
    each key's facts go back only to the lanes it was seen in. No more rows are
    made than there are input rows, and a key holding a third of them is spread
    over ``lanes`` groups.
    """
    laned = rows.withColumn("_lane", F.pmod(F.xxhash64(lane_by), F.lit(lanes)).cast("int"))
    per_lane = laned.groupBy(key, "_lane").agg(*aggregates)
    per_key = per_lane.groupBy(key).agg(F.collect_list("_lane").alias("_lanes"), *facts())
    spread = per_key.withColumn("_lane", F.explode("_lanes")).drop("_lanes")
    return laned.join(spread, [key, "_lane"]).drop("_lane")
