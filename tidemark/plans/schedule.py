"""Control plane: which tables are due, how each one is loaded, and the book-keeping.

Control tables (lower-case column names):

* config — tablename, dbname, host_port, timecols ('a|b'), primarykeys ('k1|k2'),
  targettable, watermark ('yyyy-MM-dd' of the last good run), dbversion,
  mappings (JSON ``{old: new}``), status ('1' = enabled), comments
* connections — db_name, host_port (ignored), username, passwd

Everything is a DataFrame transformation; the schedule is the only thing a
caller collects (one row per table), and only to drive per-table loads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.lists import json_map_error, parse_json_map, split_list
from tidemark.functions.watermark import parse_run_date
from tidemark.operators.sizing import checked_broadcast

CONFIG_COLUMNS = ["tablename", "dbname", "host_port", "timecols", "primarykeys", "targettable",
                  "watermark", "dbversion", "mappings", "status", "comments"]
SCHEDULE_COLUMNS = ["tablename", "dbname", "host_port", "timecols", "primarykeys", "targettable",
                    "watermark", "username", "passwd", "dbversion", "mappings"]
# Connections are one row per source database; broadcast only when proven that small.
CONNECTIONS_BROADCAST_ROWS = 100_000

SUCCESS, FAILED = "SUCCESS", "FAILED"


def lower_columns(df: DataFrame) -> DataFrame:
    """Control tables from databases often come back upper-case; normalise."""
    return df.toDF(*[c.lower() for c in df.columns])


def pending_tasks(config: DataFrame, run_date: str) -> DataFrame:
    """Config rows not yet loaded on ``run_date`` (watermark differs or is NULL)."""
    d = parse_run_date(run_date)
    wm = F.col("watermark")
    return config.filter((wm != F.lit(d)) | wm.isNull())


def build_schedule(config: DataFrame, connections: DataFrame, run_date: str) -> DataFrame:
    """Due, enabled tables that have credentials, with the connection user attached."""
    cfg = pending_tasks(lower_columns(config), run_date)
    conns = lower_columns(connections).drop("host_port").distinct()
    conns = checked_broadcast(conns, CONNECTIONS_BROADCAST_ROWS)
    joined = cfg.join(conns, cfg["dbname"] == conns["db_name"], "left")
    return (joined.filter(F.col("status") == "1")
            .filter(F.col("passwd").isNotNull())
            .select(*[cfg[c] if c in cfg.columns else conns[c] for c in SCHEDULE_COLUMNS])
            .distinct())


def parse_tasks(schedule: DataFrame, url_prefix: str = "jdbc:mysql://") -> DataFrame:
    """Lists, mapping and URL as typed columns; ``is_incremental`` when both a
    time-column list and a watermark exist."""
    time_cols = split_list("timecols")
    return schedule.withColumns({
        "url": F.concat(F.lit(url_prefix), F.col("host_port")),
        "time_cols": time_cols,
        "primary_keys": split_list("primarykeys"),
        "mapping": parse_json_map("mappings"),
        "mapping_error": json_map_error("mappings"),
        "is_incremental": time_cols.isNotNull() & F.col("watermark").isNotNull(),
    })


def with_load_mode(tasks: DataFrame, run_date: str) -> DataFrame:
    """``full`` (overwrite) without watermark or time columns, ``skip`` when
    already loaded on ``run_date``, else ``incremental`` (append / upsert)."""
    d = parse_run_date(run_date)
    if "time_cols" not in tasks.columns:
        tasks = parse_tasks(tasks)
    mode = (F.when(F.col("watermark").isNull() | F.col("time_cols").isNull(), F.lit("full"))
            .when(F.col("watermark") == F.lit(d), F.lit("skip"))
            .otherwise(F.lit("incremental")))
    return tasks.withColumn("load_mode", mode).withColumn(
        "write_mode", F.when(F.col("load_mode") == "full", F.lit("overwrite")).otherwise(F.lit("append")))


def apply_run_results(config: DataFrame, results: DataFrame, run_date: str,
                      key: str = "targettable") -> DataFrame:
    """New config: on SUCCESS the watermark moves to ``run_date`` (the run's
    start date) and comments = 'SUCCESS'; on FAILED only comments change. A
    table with several results counts as FAILED if any of them failed."""
    d = parse_run_date(run_date)
    cfg = lower_columns(config)
    res = (lower_columns(results).groupBy(key)
           .agg(F.max((F.col("status") == FAILED).cast("int")).alias("_failed"))
           .select(F.col(key).alias("_rkey"),
                   F.when(F.col("_failed") == 1, F.lit(FAILED)).otherwise(F.lit(SUCCESS)).alias("_status")))
    j = cfg.join(res, cfg[key] == res["_rkey"], "left")
    out = j.withColumns({
        "watermark": F.when(F.col("_status") == SUCCESS, F.lit(d)).otherwise(F.col("watermark")),
        "comments": F.coalesce(F.col("_status"), F.col("comments")),
    })
    return out.select(*cfg.columns)


def apply_unique_results(config: DataFrame, checks: DataFrame) -> DataFrame:
    """Write 'Unique' / 'Not Unique' into comments by (dbname, tablename).

    A table that was checked several times (for several targets) is 'Not Unique' if
    any check says so; every config row stays one row."""
    cfg = lower_columns(config)
    verdict = F.when(F.max((F.col("comment") != "Unique").cast("int")) == 1, F.lit("Not Unique")).otherwise(F.lit("Unique"))
    chk = checks.groupBy(F.col("dbname").alias("_db"), F.col("tablename").alias("_tb")).agg(verdict.alias("_comment"))
    j = cfg.join(chk, (cfg["dbname"] == chk["_db"]) & (cfg["tablename"] == chk["_tb"]), "left")
    return j.withColumn("comments", F.coalesce(F.col("_comment"), F.col("comments"))).select(*cfg.columns)
