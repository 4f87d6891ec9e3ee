"""Column catalogs ``(table_name, ordinal, field, src_type)``.

* ``jdbc_column_catalog`` — one JDBC read of ``information_schema.columns``
  for every table of a schema (instead of one ``DESCRIBE`` per table on the
  driver).
* ``schema_catalog`` — for sources without a database catalog (files, lake
  tables): the source type is derived from the Spark type alone, no data is read;
  text columns get one declared type.
* ``profile_catalog`` — the same with text types measured (an explicit choice: it scans
  every text column): the longest value in bytes, as the limits count them, decides
  varchar(n) / text / mediumtext / longtext. Integer widths follow the declared type, never the values seen so
  far (a key that fits a smallint today overflows tomorrow). One aggregation
  per table, all tables in one job; one row per table leaves the aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATALOG_COLUMNS = ["table_name", "ordinal", "field", "src_type"]

# MySQL text sizes (public MySQL limits).
VARCHAR_LIMIT = 4000
TEXT_LIMITS = [("text", 65535), ("mediumtext", 16777215)]


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _default_int(dtype: T.DataType) -> str:
    return {T.ByteType: "tinyint", T.ShortType: "smallint", T.IntegerType: "int"}.get(type(dtype), "bigint")


def _static_type(dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "bit(1)"
    if isinstance(dtype, T.FloatType):
        return "float"
    if isinstance(dtype, T.DoubleType):
        return "double"
    if isinstance(dtype, T.DecimalType):
        return f"decimal({dtype.precision},{dtype.scale})"
    if isinstance(dtype, T.DateType):
        return "date"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(dtype, T.BinaryType):
        return "blob"
    return "json"  # arrays, maps, structs


def _text_type(max_len: Column) -> Column:
    n = F.coalesce(max_len, F.lit(0))
    expr = F.when(n <= VARCHAR_LIMIT, F.concat(F.lit("varchar("), F.greatest(n, F.lit(1)).cast("string"), F.lit(")")))
    for name, limit in TEXT_LIMITS:
        expr = expr.when(n <= limit, F.lit(name))
    return expr.otherwise(F.lit("longtext"))


def profile_table(df: DataFrame, table_name: str) -> DataFrame:
    aggs: list[Column] = [F.lit(1).alias("_one")]
    types: list[tuple[int, str, Column]] = []
    for i, f in enumerate(df.schema.fields, 1):
        c = F.col(_q(f.name))
        if isinstance(f.dataType, T.StringType):
            aggs.append(F.max(F.octet_length(c)).alias(f"_len{i}"))
            types.append((i, f.name, _text_type(F.col(f"_len{i}"))))
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            types.append((i, f.name, F.lit(_default_int(f.dataType))))
        else:
            types.append((i, f.name, F.lit(_static_type(f.dataType))))
    stats = df.agg(*aggs) if len(aggs) > 1 else df.sparkSession.range(1)
    rows = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(name).alias("field"), t.alias("src_type"))
                     for i, name, t in types])
    return stats.select(F.lit(table_name).alias("table_name"), F.explode(rows).alias("_c")).select(
        "table_name", "_c.ordinal", "_c.field", "_c.src_type")


def schema_catalog(tables: Mapping[str, DataFrame], text_type: str = "text") -> DataFrame:
    """Catalog from the tables' schemas; every text column is declared ``text_type``."""
    rows = [(name, i, f.name, text_type if isinstance(f.dataType, T.StringType) else _declared(f.dataType))
            for name, df in tables.items() for i, f in enumerate(df.schema.fields, 1)]
    return catalog_frame(next(iter(tables.values())).sparkSession, rows)


def _declared(dtype: T.DataType) -> str:
    integral = isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return _default_int(dtype) if integral else _static_type(dtype)


def profile_catalog(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [profile_table(df, name) for name, df in tables.items()])


def jdbc_column_catalog(spark: SparkSession, url: str, schema: str, *, user: str | None = None,
                        password: str | None = None, driver: str | None = None,
                        tables: list[str] | None = None) -> DataFrame:
    """Catalog of a MySQL-compatible schema from ``information_schema.columns``."""
    from tidemark.sources.jdbc import read_jdbc

    cols = read_jdbc(spark, url, "information_schema.columns", user=user, password=password, driver=driver)
    cols = cols.toDF(*[c.lower() for c in cols.columns])
    cols = cols.filter(F.col("table_schema") == schema)
    if tables:
        cols = cols.filter(F.col("table_name").isin(*tables))
    return cols.select(
        F.col("table_name"), F.col("ordinal_position").cast("int").alias("ordinal"),
        F.col("column_name").alias("field"), F.col("column_type").alias("src_type"))


def catalog_frame(spark: SparkSession, rows: list[tuple[str, int, str, str]]) -> DataFrame:
    """A catalog from literal rows (tests, or a catalog exported elsewhere)."""
    return spark.createDataFrame(rows, "table_name string, ordinal int, field string, src_type string")
