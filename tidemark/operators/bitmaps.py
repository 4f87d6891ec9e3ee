"""Uniqueness checks that shuffle bitmaps or hashes instead of keys.

``unique_check`` groups by key: of a unique key every value crosses the network. Here one measuring pass over all tables
(rows, NULLs, and how many stretches of 32,768 neighbouring values each task sees) decides the route of each table:

* ``bitmap`` — one integral key whose values lie close together in a task (auto-increment keys do): a task sends one bitmap of 4 kB a
  stretch. Rows equal set bits: the stretch is unique. Rows of stretches that are not are grouped by key.
* ``hashes`` — any other key, also integral keys spread so thin that bitmaps would be larger than the keys:
  only 64-bit hashes are grouped. A hash of one row is a key of one row; rows of the others, repeats or collisions, are
  grouped by key.

Both confirm suspects on the keys themselves, so the report equals ``unique_check``'s.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.lists import key_list
from tidemark.operators.keys import any_null

BITMAP_BYTES, HASH_BYTES = 4096, 16
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _field(df: DataFrame, name: str) -> T.StructField | None:
    return next((f for f in df.schema.fields if f.name.lower() == name.lower()), None)


def _integral(df: DataFrame, keys: list[str]) -> bool:
    field = _field(df, keys[0]) if len(keys) == 1 else None
    return field is not None and isinstance(field.dataType, _INTEGRAL)


def measured_routes(tables: Mapping[str, tuple[DataFrame, list[str]]]) -> dict[str, str]:
    """``bitmap`` or ``hashes`` for each table; one job over the key columns of the integral ones."""
    parts = []
    for name, (df, keys) in tables.items():
        if _integral(df, keys):
            stretch = df.select(F.xxhash64(F.spark_partition_id(), F.bitmap_bucket_number(_col(keys[0]))).alias("s"))
            parts.append(stretch.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.approx_count_distinct("s").alias("bitmaps")))
    rows = reduce(DataFrame.unionByName, parts).collect() if parts else []  # one a table
    small = {r["name"] for r in rows if r["bitmaps"] * BITMAP_BYTES <= r["n"] * HASH_BYTES / 2 or r["bitmaps"] <= 64}
    return {name: "bitmap" if name in small else "hashes" for name in tables}


def _by_bitmaps(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Counts of the stretches that are unique, and the rows to be grouped by key."""
    number = F.bitmap_bucket_number(_col(key))
    rows = df.select(_col(key).alias(key), number.alias("_stretch"))
    per = (rows.where(_col(key).isNotNull()).groupBy("_stretch")
           .agg(F.count(F.lit(1)).alias("n"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(_col(key)))).alias("bits")))
    single = per.where("n = bits").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    suspect = rows.join(per.where("n > bits").select("_stretch"), "_stretch", "left_semi")
    return single, suspect.unionByName(rows.where(_col(key).isNull())).select(key)


def _by_hashes(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    rows = df.select(*[_col(k).alias(k) for k in keys])
    hashed = rows.withColumn("_hash", F.xxhash64(*map(_col, keys)))
    clear = ~any_null(keys)  # rows with a NULL are reported apart
    per = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("n"), F.max((~clear).cast("int")).alias("odd"))
    single = per.where("n = 1 AND odd = 0").agg(F.count(F.lit(1)).alias("n"))
    return single, hashed.join(per.where("n > 1 OR odd = 1").select("_hash"), "_hash", "left_semi").select(*map(_col, keys))


def compact_unique_check(tables: Mapping[str, tuple[DataFrame, str | Iterable[str]]], routes: Mapping[str, str] | None = None) -> DataFrame:
    """The report of ``unique_check_many`` over ``{name: (df, keys)}``; ``routes`` may name a table's route."""
    listed = {name: (df, key_list(keys)) for name, (df, keys) in tables.items()}
    chosen = measured_routes({n: t for n, t in listed.items() if n not in (routes or {})}) | dict(routes or {})
    reports = []
    for name, (df, keys) in listed.items():
        single, suspects = _by_bitmaps(df, keys[0]) if chosen[name] == "bitmap" else _by_hashes(df, keys)
        per_key = suspects.groupBy(*map(_col, keys)).agg(F.count(F.lit(1)).alias("n"), any_null(keys).alias("_null"))
        total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("bigint")
        counted = per_key.agg(total("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"), total((F.col("n") > 1).cast("int")).alias("n_dup_keys"),
                              total(F.when(F.col("_null"), F.col("n"))).alias("n_null_key_rows"))
        clear = single.select(F.col("n").alias("n_rows"), F.col("n").alias("n_keys"), F.lit(0).alias("n_dup_keys"), F.lit(0).alias("n_null_key_rows"))
        report = counted.unionByName(clear).agg(*[F.sum(c).cast("bigint").alias(c) for c in ("n_rows", "n_keys", "n_dup_keys", "n_null_key_rows")])
        unique = (F.col("n_dup_keys") == 0) & (F.col("n_null_key_rows") == 0)
        reports.append(report.select(F.lit(name).alias("table_name"), F.lit("|".join(keys)).alias("key_cols"), "n_rows", "n_keys", "n_dup_keys",
                                     "n_null_key_rows", unique.alias("is_unique"),
                                     F.when(unique, F.lit("Unique")).otherwise(F.lit("Not Unique")).alias("comment")))
    return reduce(DataFrame.unionByName, reports)
