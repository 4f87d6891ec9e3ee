"""The run journal: one row a task, written when the task ends.

The control table is not rewritten after each table: results are appended to a log, and the control table in force is
the stored one with the newest results of each target on top. A run that is lost at its hundredth table keeps the watermarks of the
ninety-nine before; started again it finds them done and loads the rest.

A target counts as loaded on a run date when all its tasks of that run (``of_target``, written with each row) have succeeded;
each task's last try counts. Its comment is that of its last run: FAILED if any task's last try failed.
"""

from __future__ import annotations

import threading
import time
from collections import Counter
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.functions.watermark import parse_run_date
from tidemark.plans.schedule import FAILED, SUCCESS, lower_columns

JOURNAL_SCHEMA = ("run_date string, at long, dbname string, tablename string, targettable string, load_mode string, "
                  "status string, error string, seconds double, of_target int")
_WRITING = threading.Lock()  # appends of one driver, one after another


def read_journal(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the journal (none before the first one is written)."""
    try:
        return spark.read.schema(JOURNAL_SCHEMA).json(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], JOURNAL_SCHEMA)


def append_rows(rows: DataFrame, path: str) -> None:
    """Append rows of ``JOURNAL_SCHEMA``; they count once their file is moved into place."""
    with _WRITING:
        rows.write.mode("append").json(path)


def recorder(spark: SparkSession, path: str, run_date: str, tasks: Iterable) -> Callable:
    """A function for ``run_tasks`` that appends the row of a task."""
    day = parse_run_date(run_date)
    of_target = Counter(t.targettable for t in tasks if t.load_mode != "skip")

    def record(task, status: str, error: str | None, seconds: float) -> None:
        row = (day, time.time_ns(), task.dbname, task.tablename, task.targettable, task.load_mode, status, error, seconds,
               of_target[task.targettable])
        append_rows(spark.createDataFrame([row], JOURNAL_SCHEMA).coalesce(1), path)

    return record


def current_config(config: DataFrame, journal: DataFrame) -> DataFrame:
    """The control table in force: watermarks and comments by the journal, the stored ones where it says nothing.

    ``config`` is the stored table, not one made by this function from the same journal earlier on: a plan that reads a folder
    twice may reuse its older listing. One aggregation of the journal to the last try of each task, one to a target's runs, one to the target; a watermark
    never goes back."""
    last = journal.groupBy("targettable", "run_date", "dbname", "tablename").agg(
        F.max_by("status", "at").alias("status"), F.max("at").alias("at"), F.max_by("of_target", "at").alias("of_target"))
    runs = last.groupBy("targettable", "run_date").agg(
        F.count_if(F.col("status") == SUCCESS).alias("done"), F.max_by("of_target", "at").alias("of_target"),
        F.max((F.col("status") == FAILED).cast("int")).alias("failed"))
    whole = (F.col("done") >= F.col("of_target")) & (F.col("failed") == 0)
    targets = runs.groupBy(F.col("targettable").alias("_target")).agg(
        F.max(F.when(whole, F.col("run_date"))).alias("_day"), F.max_by("failed", "run_date").alias("_failed"))
    cfg = lower_columns(config)
    joined = cfg.join(targets, cfg["targettable"] == targets["_target"], "left")
    return joined.withColumns({
        "watermark": F.greatest("watermark", "_day"),  # of ISO dates; a NULL is passed over
        "comments": F.when(F.col("_failed") == 1, F.lit(FAILED)).when(F.col("_failed") == 0, F.lit(SUCCESS)).otherwise(F.col("comments")),
    }).select(*cfg.columns)
