"""Key checks: distinct keys, duplicate keys, uniqueness report.

A table is *unique* on its declared keys when the number of distinct key
values equals the number of rows and no key holds a NULL (a NULL cannot be
part of a primary key). An empty table is unique.

All of it is one ``groupBy(keys)``: partial aggregation on the map side folds
a hot key (even one holding a third of the rows) to a single row per task
before the shuffle, so skew never lands a whole group in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.lists import key_list


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [_col(k).isNull() for k in keys])


def all_present(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [_col(k).isNotNull() for k in keys])


def distinct_keys(df: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """Distinct key tuples (a NULL is one value, as in SQL DISTINCT)."""
    return df.select(*map(_col, key_list(keys))).distinct()


def key_counts(df: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    ks = key_list(keys)
    return df.groupBy(*map(_col, ks)).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def duplicate_keys(df: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """Key tuples held by more than one row, with their row count ``n``."""
    return key_counts(df, keys).filter(F.col("n") > 1)


def unique_check(df: DataFrame, keys: str | Iterable[str], table_name: str = "") -> DataFrame:
    """One-row report: rows, distinct keys, duplicated keys, NULL-key rows, verdict."""
    ks = key_list(keys)
    per_key = df.groupBy(*map(_col, ks)).agg(F.count(F.lit(1)).alias("n"), any_null(ks).alias("_null"))
    report = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).cast("bigint").alias("n_keys"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("n_dup_keys"),
        F.coalesce(F.sum(F.when(F.col("_null"), F.col("n")).otherwise(0)), F.lit(0)).cast("bigint")
        .alias("n_null_key_rows"),
    )
    unique = (F.col("n_dup_keys") == 0) & (F.col("n_null_key_rows") == 0)
    return report.select(
        F.lit(table_name).alias("table_name"),
        F.lit("|".join(ks)).alias("key_cols"),
        "n_rows", "n_keys", "n_dup_keys", "n_null_key_rows",
        unique.alias("is_unique"),
        F.when(unique, F.lit("Unique")).otherwise(F.lit("Not Unique")).alias("comment"),
    )


def unique_check_many(tables: Mapping[str, tuple[DataFrame, str | Iterable[str]]]) -> DataFrame:
    """Union of ``unique_check`` over ``{name: (df, keys)}``; runs as one job."""
    reports = [unique_check(df, keys, name) for name, (df, keys) in tables.items()]
    return reduce(DataFrame.unionByName, reports)
