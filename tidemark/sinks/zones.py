"""Zone maps of lake tables: which files can hold rows of a time slice.

A hash-keyed table has rows of all times in every bucket, so a time filter prunes no bucket. Its files differ, though: base
files are as old as the last full load or compaction, appended files and deltas hold what came since. ``_zones`` keeps, for each
file, its rows and the smallest and largest value of the time columns, made by one aggregation over ``_metadata.file_path``
of the files it doesn't know yet. A slice joins the table's current files with it and opens those whose largest
value reaches the bound, and those it has no zone of; files are never changed once written, so a zone never ages.

A slice is asked for with the same predicate as everywhere (``incremental_filter``): every comparison in it is ``column >=
literal``, true for some row of a file exactly if it is true for the file's largest values. The driver holds the names of
the table's files, never rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.functions.lists import key_list
from tidemark.operators.incremental import incremental_filter
from tidemark.operators.sizing import DEFAULT_BROADCAST_ROWS
from tidemark.sinks.deltas import read_log
from tidemark.sinks.lake import BUCKET_COL, current, read_layout, stored_layout

ZONES_DIR = "_zones"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _leaf(path: str) -> str:
    return f"/{path.rstrip('/').rsplit('/', 1)[-1]}/"


def data_files(table: DataFrame, path: str) -> dict[str, str]:
    """The files of a table: name below the table's folder → full name."""
    return {f.rsplit(_leaf(path), 1)[-1]: f for f in table.inputFiles()}


def read_zones(spark: SparkSession, path: str) -> DataFrame | None:
    """``(file, n_rows, lo, hi)``, the last two structs of the time columns; None if the table has no zone map."""
    try:
        return spark.read.parquet(f"{path.rstrip('/')}/{ZONES_DIR}")
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def refresh_zones(spark: SparkSession, path: str, time_cols: str | Iterable[str], fmt: str = "parquet") -> int:
    """Add the zones of files that have none yet (all files if the time columns are others); returns how many."""
    cols = key_list(time_cols)
    table = spark.read.format(fmt).load(path)
    files = data_files(table, path)
    zones = read_zones(spark, path)
    known = set()
    if zones is not None and set(zones.schema["hi"].dataType.fieldNames()) >= set(cols):
        known = {r["file"] for r in zones.select("file").distinct().collect()}  # names only
    new = [full for name, full in files.items() if name not in known]
    if not new:
        return 0
    rows = spark.read.format(fmt).schema(table.schema).option("basePath", path).load(new)
    made = rows.groupBy(F.substring_index(F.col("_metadata.file_path"), _leaf(path), -1).alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.struct(*[F.min(_q(c)).alias(c) for c in cols]).alias("lo"),
        F.struct(*[F.max(_q(c)).alias(c) for c in cols]).alias("hi"))
    made.coalesce(1).write.mode("append" if known else "overwrite").parquet(f"{path.rstrip('/')}/{ZONES_DIR}")
    return len(new)


def slice_files(spark: SparkSession, path: str, table: DataFrame, time_cols: list[str], watermark: str, *, unit: str = "s",
                overlap_days: int = 0, tz: str = "UTC") -> list[str] | None:
    """The files of ``table`` that can hold due rows; None if the table has no zone map for these columns."""
    zones = read_zones(spark, path)
    if zones is None or not set(zones.schema["hi"].dataType.fieldNames()) >= set(time_cols):
        return None
    files = data_files(table, path)
    here = spark.createDataFrame([(name,) for name in files], "file string")
    mapped = here.join(zones.dropDuplicates(["file"]), "file").select("file", *[F.col(f"hi.{_q(c)}").alias(c) for c in time_cols])
    due = incremental_filter(mapped, time_cols, watermark, unit, overlap_days, tz).select("file", F.lit(True).alias("due"))
    marked = mapped.select("file").join(due, "file", "left").collect()  # names of the table's files
    opened = set(files) - {r["file"] for r in marked if not r["due"]}  # also those without a zone
    return [files[name] for name in sorted(opened)]


def read_slice(spark: SparkSession, path: str, time_cols: str | Iterable[str], watermark: str, *, unit: str = "s",
               overlap_days: int = 0, tz: str = "UTC", fmt: str = "parquet",
               broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """The rows of a lake table with any time column at or after the watermark; opens only files that can hold some.

    Deltas are resolved as in ``read_lake``: a row that is not opened isn't due, whatever came after it."""
    cols = key_list(time_cols)
    layout = stored_layout(spark, path)
    known = layout is not None and layout.schema is not None  # else the schema is taken from some file
    table = (spark.read.schema(layout.file_schema()) if known else spark.read).format(fmt).load(path)
    files = slice_files(spark, path, table, cols, watermark, unit=unit, overlap_days=overlap_days, tz=tz)
    if files is not None:
        schema = table.schema
        table = spark.read.format(fmt).schema(schema).option("basePath", path).load(files) if files else spark.createDataFrame([], schema)
    if BUCKET_COL in table.columns:
        log = read_log(spark, path)
        if log:
            table = current(spark, path, table, layout or read_layout(spark, path), log, fmt, broadcast_rows)
        table = table.drop(BUCKET_COL)
    return incremental_filter(table, cols, watermark, unit, overlap_days, tz)
