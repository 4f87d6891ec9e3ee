"""Per-table loads and the nightly run.

The schedule (one row per due table) is the only data collected to the
driver. For each table the work is a DataFrame plan — read → time slice →
rename → upsert / swap / replace — executed by the sink's action on the
executors. ``run_tasks`` isolates failures: a failing table yields a FAILED
result row and the others go on; several tables can load at once
(``parallelism``), each as its own Spark job.
"""

from __future__ import annotations

import logging
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.columns import rename_columns
from tidemark.operators.incremental import incremental_filter
from tidemark.operators.upsert import stage_swap
from tidemark.plans.ddl import target_ddl
from tidemark.plans.journal import current_config, read_journal, recorder
from tidemark.plans.schedule import FAILED, SUCCESS, apply_run_results, build_schedule, parse_tasks, with_load_mode
from tidemark.session import remove_dir, shared_dir
from tidemark.sinks.lake import merge_into_table, overwrite_lake, read_lake, swap_lake, upsert_lake
from tidemark.sinks.zones import read_slice, refresh_zones
from tidemark.sources.jdbc import (
    drop_statement, read_jdbc_balanced, read_jdbc_parallel, staging_name, swap_statements, write_jdbc,
)

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class LoadTask:
    tablename: str
    dbname: str
    targettable: str
    primary_keys: tuple[str, ...]
    time_cols: tuple[str, ...] | None = None
    watermark: str | None = None
    load_mode: str = "full"
    url: str | None = None
    username: str | None = None
    passwd: str | None = field(default=None, repr=False)
    mapping: Mapping[str, str] | None = None
    mapping_error: bool = False
    tz: str = "UTC"  # the clock of the source's time columns
    epoch_unit: str = "s"  # of numeric time columns: 's' or 'ms'
    overlap_days: int = 0  # days before the watermark that are read again
    read_key: str | None = None  # splits a parallel source read; default: the first primary key
    catalog_table: str | None = None  # a named lake table instead of a path under the lake's root

    def renamed(self, column: str) -> str:
        """The column's name after the task's rename (names compared case-insensitively)."""
        m = {k.lower(): v for k, v in (self.mapping or {}).items()}
        return m.get(column.lower(), column)


def tasks_from(modes: DataFrame) -> list[LoadTask]:
    """Collect the (small) schedule with load modes into task records."""
    out = []
    for r in modes.collect():
        d = r.asDict()
        out.append(LoadTask(
            tablename=d["tablename"], dbname=d.get("dbname"), targettable=d["targettable"],
            primary_keys=tuple(d.get("primary_keys") or ()),
            time_cols=tuple(d["time_cols"]) if d.get("time_cols") else None,
            watermark=d.get("watermark"), load_mode=d.get("load_mode", "full"), url=d.get("url"),
            username=d.get("username"), passwd=d.get("passwd"),
            mapping=dict(d["mapping"]) if d.get("mapping") else None,
            mapping_error=bool(d.get("mapping_error")), tz=d.get("tz") or "UTC", epoch_unit=d.get("epoch_unit") or "s",
            overlap_days=int(d.get("overlap_days") or 0), read_key=d.get("read_key"),
            catalog_table=d.get("catalog_table")))
    return out


SourceReader = Callable[[SparkSession, LoadTask], DataFrame]


def file_source(root: str, fmt: str = "parquet") -> SourceReader:
    """Source tables as files ``root/<tablename>.<fmt>``."""
    def read(spark: SparkSession, task: LoadTask) -> DataFrame:
        return spark.read.format(fmt).load(f"{root.rstrip('/')}/{task.tablename}.{fmt}")
    return read


def jdbc_source(driver: str | None = None, key_column: str | None = None, num_partitions: int | None = None,
                fetch_size: int = 10_000, balanced: bool = False) -> SourceReader:
    """Source tables over JDBC, credentials from the schedule.

    With ``num_partitions`` the read is split by ``key_column``, else by the task's ``read_key``, else by its
    first primary key, where that is numeric or temporal; other tables are read in one task.
    ``balanced=True`` takes equal-row partitions from database-side tiles instead of key strides."""
    def read(spark: SparkSession, task: LoadTask) -> DataFrame:
        table = f"{task.dbname}.{task.tablename}"
        key = split_key(task, key_column)
        split = read_jdbc_balanced if balanced and key else read_jdbc_parallel
        return split(spark, task.url, table, key, num_partitions or 1, user=task.username, password=task.passwd,
                     driver=driver, fetch_size=fetch_size)
    return read


def split_key(task: LoadTask, key_column: str | None = None) -> str | None:
    """The column that splits the task's source read."""
    return key_column or task.read_key or (task.primary_keys[0] if task.primary_keys else None)


def task_slice(df: DataFrame, task: LoadTask, time_cols: Iterable[str]) -> DataFrame:
    """The rows at or after the task's watermark, by the task's clock, epoch unit and overlap."""
    return incremental_filter(df, list(time_cols), task.watermark, task.epoch_unit, task.overlap_days, task.tz)


def source_slice(spark: SparkSession, task: LoadTask, reader: SourceReader) -> DataFrame:
    """Rows to move: the whole table, or the time slice since the watermark; renamed."""
    if task.mapping_error:
        raise ValueError(f"{task.tablename}: column mapping is not a JSON object")
    df = reader(spark, task)
    if task.load_mode == "incremental":
        df = task_slice(df, task, task.time_cols)
    elif task.load_mode == "skip":
        df = df.filter(F.lit(False))
    return rename_columns(df, task.mapping)


# ------------------------------------------------------------------ warehouses
class Warehouse(Protocol):
    def replace(self, spark: SparkSession, df: DataFrame, table: str, keys: tuple[str, ...]) -> None: ...
    def swap(self, spark: SparkSession, df: DataFrame, table: str, keys: tuple[str, ...]) -> None: ...


@dataclass
class LakeWarehouse:
    """A warehouse made of keyed lake tables (file based)."""
    root: str
    fmt: str = "parquet"
    n_buckets: int | None = None
    range_width: int | None = None
    crash_safe: bool = False

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def replace(self, spark, df, table, keys):
        overwrite_lake(spark, df, self.path(table), keys=keys, n_buckets=self.n_buckets, fmt=self.fmt,
                       range_width=self.range_width, crash_safe=self.crash_safe)

    def swap(self, spark, df, table, keys):
        swap_lake(spark, df, self.path(table), keys, fmt=self.fmt)

    def read(self, spark, table) -> DataFrame:
        return read_lake(spark, self.path(table), self.fmt)


@dataclass
class JdbcWarehouse:
    """A JDBC warehouse. ``execute`` runs SQL statements in the warehouse (the
    caller's database client); with it a swap is stage + set-based DELETE/INSERT.
    Without it the swap is computed in Spark (stage_swap of the current target
    and the stage), materialised to the shared folder, and written back with
    truncate-overwrite — the target is never read and overwritten in one job."""
    url: str
    schema: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    num_partitions: int = 20
    execute: Callable[[list[str]], None] | None = None

    def _conn(self) -> dict:
        return {"user": self.user, "password": self.password, "driver": self.driver}

    def qualified(self, table: str) -> str:
        return f"{self.schema}.{table}" if self.schema else table

    def replace(self, spark, df, table, keys):
        write_jdbc(df, self.url, self.qualified(table), mode="overwrite", truncate=True,
                   num_partitions=self.num_partitions, **self._conn())

    def swap(self, spark, df, table, keys):
        target = self.qualified(table)
        if self.execute is not None:
            staging = staging_name(target)
            write_jdbc(df, self.url, staging, mode="overwrite", num_partitions=self.num_partitions, **self._conn())
            self.execute([*swap_statements(target, staging, keys, df.columns), drop_statement(staging)])
            return
        # a live source is read once: everything below sees the same stage
        stage_path, merged_path = shared_dir(spark, "warehouse-stage"), shared_dir(spark, "warehouse-swap")
        stage_schema = df.schema
        df.write.mode("overwrite").parquet(stage_path)
        stage = spark.read.schema(stage_schema).parquet(stage_path)
        current = read_jdbc_parallel(spark, self.url, target, keys[0] if keys else None, self.num_partitions,
                                     zero_dates_to_null=False, **self._conn())
        stage_swap(current, stage, keys).write.mode("overwrite").parquet(merged_path)
        merged = spark.read.schema(current.schema).parquet(merged_path)
        wanted = merged.count()
        write_jdbc(merged, self.url, target, mode="overwrite", truncate=True, num_partitions=self.num_partitions,
                   **self._conn())
        written = read_jdbc_parallel(spark, self.url, target, None, 1, zero_dates_to_null=False, **self._conn()).count()
        if written != wanted:  # the merged rows are kept for another try
            raise RuntimeError(f"{target} holds {written} rows after the swap, not {wanted}; the rows are in {merged_path}")
        remove_dir(spark, stage_path)
        remove_dir(spark, merged_path)


def create_targets(spark: SparkSession, tasks: Iterable[LoadTask], catalog: DataFrame,
                   execute: Callable[[list[str]], None], *, schema: str = "DW") -> DataFrame:
    """Create the tasks' target tables in the warehouse: column catalog → renames → types → DDL → ``execute``.

    ``catalog`` is that of the sources (``jdbc_column_catalog``, ``schema_catalog`` or ``profile_catalog``). Only
    statements without a fault (no unmapped or narrowed column, no name too long) are run; the returned rows,
    one a table, say which. A failing statement fails its own table only."""
    by_table = {t.tablename: t for t in tasks}
    ddl = target_ddl(catalog.where(F.col("table_name").isin(list(by_table))), schema,
                     renames={n: dict(t.mapping or {}) for n, t in by_table.items()},
                     table_names={n: t.targettable for n, t in by_table.items()})
    out = []
    for r in ddl.collect():  # one row a table of the schedule
        status, error = "REFUSED", None
        if r["ok"] and not by_table[r["table_name"]].mapping_error:
            try:
                execute([r["ddl"]])
                status = SUCCESS
            except Exception as exc:  # noqa: BLE001 — isolate the table, keep going
                status, error = FAILED, f"{type(exc).__name__}: {exc}"
        out.append((r["table_name"], by_table[r["table_name"]].targettable, r["ddl"], status, error))
    return spark.createDataFrame(out, "tablename string, targettable string, ddl string, status string, error string")


# ------------------------------------------------------------------ loads
def load_to_lake(spark: SparkSession, task: LoadTask, reader: SourceReader, lake_root: str, *,
                 fmt: str = "parquet", n_buckets: int | None = None, range_width: int | None = None,
                 crash_safe: bool = False, as_delta: bool = False, zones: bool = False) -> str:
    """Source → lake: full = replace the table (no key needed), incremental = MERGE by key.

    An incremental load needs the table it updates: without it the task fails, and its watermark
    stays, rather than leave a table that holds only the slice.

    ``crash_safe=True`` keeps the old rows readable until the new ones commit
    (at the price of a second write); otherwise a full load whose write fails leaves the
    table empty until it is re-run. ``as_delta=True`` writes an incremental slice as a delta, ``zones=True``
    keeps the zone map of the task's time columns.

    A task with ``catalog_table`` goes to that named table instead: in full by overwriting it, incrementally by
    the table format's own MERGE."""
    path = f"{lake_root.rstrip('/')}/{task.targettable}"
    if task.load_mode == "skip":
        return path
    if task.catalog_table:
        data = source_slice(spark, task, reader)
        if task.load_mode == "full":
            data.write.mode("overwrite").saveAsTable(task.catalog_table)
        elif not task.primary_keys:
            raise ValueError(f"{task.tablename}: an incremental load needs primary keys")
        else:
            merge_into_table(data, task.catalog_table, [task.renamed(k) for k in task.primary_keys])
        return task.catalog_table
    data = source_slice(spark, task, reader)
    keys = tuple(task.renamed(k) for k in task.primary_keys)
    if task.load_mode == "full":
        overwrite_lake(spark, data, path, keys=keys, n_buckets=n_buckets, fmt=fmt, range_width=range_width,
                       crash_safe=crash_safe)
    else:
        if not keys:
            raise ValueError(f"{task.tablename}: an incremental load needs primary keys")
        upsert_lake(spark, data, path, keys, fmt=fmt, as_delta=as_delta)
    if zones and task.time_cols:
        refresh_zones(spark, path, [task.renamed(c) for c in task.time_cols], fmt)
    return path


def publish_to_warehouse(spark: SparkSession, task: LoadTask, lake_root: str, warehouse: Warehouse, *,
                         fmt: str = "parquet") -> None:
    """Lake → warehouse: the lake's time slice is swapped in by key; a full load replaces.

    Where the lake table has a zone map, only files that can hold due rows are opened."""
    if task.load_mode == "skip":
        return
    path = f"{lake_root.rstrip('/')}/{task.targettable}"
    keys = tuple(task.renamed(k) for k in task.primary_keys)
    if task.load_mode == "incremental":
        data = read_slice(spark, path, [task.renamed(c) for c in task.time_cols], task.watermark, unit=task.epoch_unit,
                          overlap_days=task.overlap_days, tz=task.tz, fmt=fmt)
        warehouse.swap(spark, data, task.targettable, keys)
    else:
        warehouse.replace(spark, read_lake(spark, path, fmt), task.targettable, keys)


def load_to_warehouse(spark: SparkSession, task: LoadTask, reader: SourceReader, warehouse: Warehouse) -> None:
    """Source → warehouse directly: full replaces, incremental swaps by key."""
    if task.load_mode == "skip":
        return
    data = source_slice(spark, task, reader)
    keys = tuple(task.renamed(k) for k in task.primary_keys)
    if task.load_mode == "full":
        warehouse.replace(spark, data, task.targettable, keys)
    else:
        warehouse.swap(spark, data, task.targettable, keys)


@contextmanager
def _tagged(spark: SparkSession, task: LoadTask, time_limit: float | None):
    """Jobs of this thread carry a tag and a pool of their own; past the limit they are cancelled and the task fails."""
    context = spark.sparkContext
    tag, over = f"tidemark-{uuid.uuid4().hex}", threading.Event()

    def stop() -> None:
        over.set()
        while not ended.wait(0.5):  # again for jobs that the task starts after that
            context.cancelJobsWithTag(tag)

    ended = threading.Event()
    timer = threading.Timer(time_limit, stop) if time_limit is not None else None
    mine = {"spark.scheduler.pool": task.targettable, "spark.job.interruptOnCancel": "true"}
    before = {name: context.getLocalProperty(name) for name in mine}
    context.addJobTag(tag)
    for name, value in mine.items():
        context.setLocalProperty(name, value)
    if timer is not None:
        timer.daemon = True
        timer.start()
    try:
        yield
    except Exception as exc:
        if over.is_set():
            raise TimeoutError(f"stopped after {time_limit} seconds") from exc
        raise
    finally:
        ended.set()
        if timer is not None:
            timer.cancel()
        context.removeJobTag(tag)
        for name, value in before.items():
            context.setLocalProperty(name, value)


RESULT_SCHEMA = "tablename string, targettable string, load_mode string, status string, error string, seconds double"


def run_tasks(spark: SparkSession, tasks: Iterable[LoadTask], fn: Callable[[LoadTask], object], *,
              parallelism: int = 1, time_limit: float | None = None,
              record: Callable[[LoadTask, str, str | None, float], None] | None = None) -> DataFrame:
    """Run ``fn`` per table; one result row each (SUCCESS / FAILED + error).

    ``record`` is called when a table ends, before the next one of its thread begins (``journal.recorder`` keeps it).
    ``time_limit`` in seconds: the Spark jobs of a table that runs longer are cancelled by its tag, the table fails and
    the others go on. Each table's jobs run in a scheduler pool of the table's name, so
    that under fair scheduling a large table doesn't hold up the small ones."""
    def one(task: LoadTask):
        t0 = time.time()
        try:
            with _tagged(spark, task, time_limit):
                fn(task)
            status, msg = SUCCESS, None
        except Exception as exc:  # noqa: BLE001 — isolate the table, keep going
            status, msg = FAILED, f"{type(exc).__name__}: {exc}"
            log.warning("table %s failed: %s", task.tablename, msg.splitlines()[0])
            log.debug("table %s traceback", task.tablename, exc_info=True)
        if record is not None:
            record(task, status, msg, time.time() - t0)
        return (task.tablename, task.targettable, task.load_mode, status, msg, time.time() - t0)

    todo = [t for t in tasks if t.load_mode != "skip"]
    if parallelism > 1:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            rows = list(pool.map(one, todo))
    else:
        rows = [one(t) for t in todo]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def nightly_lake_run(spark: SparkSession, config: DataFrame, connections: DataFrame, run_date: str,
                     reader: SourceReader, lake_root: str, *, parallelism: int = 1, fmt: str = "parquet",
                     n_buckets: int | None = None, crash_safe: bool = False, as_delta: bool = False, zones: bool = False,
                     journal: str | None = None, time_limit: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Schedule → per-table lake loads → (results, new config with watermarks advanced).

    ``journal`` names the run journal: each table's result is kept there when the table ends, ``config`` is read with
    the journal on top, and a run that was lost goes on with the tables that it had not loaded."""
    stored = config
    if journal is not None:
        config = current_config(stored, read_journal(spark, journal))
    modes = with_load_mode(parse_tasks(build_schedule(config, connections, run_date)), run_date)
    tasks = tasks_from(modes)
    results = run_tasks(spark, tasks, lambda t: load_to_lake(spark, t, reader, lake_root, fmt=fmt, n_buckets=n_buckets,
                                                             crash_safe=crash_safe, as_delta=as_delta, zones=zones),
                        parallelism=parallelism, time_limit=time_limit,
                        record=recorder(spark, journal, run_date, tasks) if journal is not None else None)
    if journal is not None:
        return results, current_config(stored, read_journal(spark, journal))
    return results, apply_run_results(config, results, run_date)
