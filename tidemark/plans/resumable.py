"""Loads of huge tables that go on where they stopped.

The table is cut into exact key ranges (``counted_ranges``: counted, never sorted), which are written down before anything is
read. Each range is staged as a table of its own and recorded when its write is committed. A rerun takes the same
ranges and loads those that have no record; the target is replaced once all are there, from the staged rows, so it is never half a load.
A live source may change between two ranges, as between two pages; within a range it is read once.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tidemark.operators.selection import counted_ranges
from tidemark.session import remove_dir
from tidemark.sinks.lake import overwrite_lake

PLAN_SCHEMA = "range_id int, lo string, hi string, n long, key string, source string"
DONE_SCHEMA = "range_id int, n long"


class PlanMismatch(ValueError):
    """The staging folder belongs to the load of another source or key."""


def _rows(spark: SparkSession, schema: str, path: str) -> list:
    try:
        return spark.read.schema(schema).json(path).collect()  # one row a range
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def range_condition(key: str, kind: T.DataType, lo: str | None, hi: str | None) -> Column:
    k = F.col("`" + key.replace("`", "``") + "`")
    return k.isNull() if lo is None else (k >= F.lit(lo).cast(kind)) & (k <= F.lit(hi).cast(kind))


def planned_ranges(spark: SparkSession, source: DataFrame, key: str, staging: str, rows_per_range: int) -> list:
    """The ranges of this load: those written down before, else counted now and written down."""
    shape = source.schema.simpleString()
    found = _rows(spark, PLAN_SCHEMA, f"{staging}/_plan")
    if not found:
        made = counted_ranges(source, key, rows_per_range)
        kind = source.schema[key].dataType
        typed = [(i, lo, hi, n) for i, (lo, hi, n) in enumerate(made)]
        schema = T.StructType([T.StructField("range_id", T.IntegerType()), T.StructField("lo", kind), T.StructField("hi", kind), T.StructField("n", T.LongType())])
        rows = spark.createDataFrame(typed, schema).select("range_id", F.col("lo").cast("string"), F.col("hi").cast("string"), "n",
                                                           F.lit(key).alias("key"), F.lit(shape).alias("source"))
        rows.coalesce(1).write.mode("overwrite").json(f"{staging}/_plan")
        found = _rows(spark, PLAN_SCHEMA, f"{staging}/_plan")
    if any((r["key"], r["source"]) != (key, shape) for r in found):
        raise PlanMismatch(f"{staging} holds the ranges of another load")
    return sorted(found, key=lambda r: r["range_id"])


def resumable_load(spark: SparkSession, source: DataFrame, path: str, key: str, staging: str, *, keys: str | list[str] | None = None,
                   rows_per_range: int = 1_000_000, parallelism: int = 1, n_buckets: int | None = None, fmt: str = "parquet",
                   on_range: Callable[[int, DataFrame], DataFrame] | None = None) -> int:
    """Load ``source`` into the lake table at ``path`` by ranges of ``key``; returns the ranges loaded this time.

    ``staging`` names the load: a shared folder that stays until the table is replaced. ``keys``: the lake table's keys.
    ``on_range`` sees each range's rows before they are staged (a rename, a check)."""
    staging = staging.rstrip("/")
    ranges = planned_ranges(spark, source, key, staging, rows_per_range)
    done = {r["range_id"] for r in _rows(spark, DONE_SCHEMA, f"{staging}/_done")}
    missing = [r for r in ranges if r["range_id"] not in done]
    kind, lock = source.schema[key].dataType, threading.Lock()

    def stage(r) -> None:
        rows = source.where(range_condition(key, kind, r["lo"], r["hi"]))
        if on_range is not None:
            rows = on_range(r["range_id"], rows)
        rows.write.mode("overwrite").parquet(f"{staging}/rows/_range={r['range_id']}")  # what a lost try left goes
        with lock:  # appends of one driver, one after another
            spark.createDataFrame([(r["range_id"], r["n"])], DONE_SCHEMA).coalesce(1).write.mode("append").json(f"{staging}/_done")

    if parallelism > 1:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            list(pool.map(stage, missing))
    else:
        for r in missing:
            stage(r)
    schema = (on_range(-1, source.limit(0)) if on_range is not None else source).schema
    staged = spark.read.schema(T.StructType([*schema.fields, T.StructField("_range", T.IntegerType())])).parquet(f"{staging}/rows").drop("_range") \
        if ranges else spark.createDataFrame([], schema)
    overwrite_lake(spark, staged, path, keys=keys, n_buckets=n_buckets, fmt=fmt)
    remove_dir(spark, staging)
    return len(missing)
