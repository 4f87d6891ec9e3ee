"""Target-table DDL from a mapped column catalog.

``target_ddl`` builds ``create table SCHEMA.T ( "c1" type1,"c2" type2 )`` per
table with one ``groupBy(table)``: columns are gathered in ordinal order
(a table has a bounded number of columns, so the per-table list is small).
Renames are applied before the DDL is built, with names compared as the loads compare
them (case-insensitively), through a join with the renames' own rows. Names longer than
the target's identifier limit and columns narrowed by the mapping are reported (``ok`` is
false) instead of failing at CREATE or at load time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.typemap import map_types

IDENTIFIER_MAX = 30


def apply_catalog_renames(catalog: DataFrame, renames: Mapping[str, Mapping[str, str]] | None) -> DataFrame:
    """Rename fields per table, ``{table: {old: new}}``; field names are compared case-insensitively."""
    rows = [(t, old.lower(), new) for t, mapping in (renames or {}).items() for old, new in mapping.items()]
    if not rows:
        return catalog
    given = catalog.sparkSession.createDataFrame(rows, "_table string, _old string, _new string").dropDuplicates(["_table", "_old"])
    joined = catalog.join(given, (F.col("table_name") == F.col("_table")) & (F.lower("field") == F.col("_old")), "left")
    return joined.withColumn("field", F.coalesce("_new", "field")).drop("_table", "_old", "_new")


def target_ddl(catalog: DataFrame, schema: str = "DW", *, max_name_len: int = IDENTIFIER_MAX,
               renames: Mapping[str, Mapping[str, str]] | None = None,
               table_names: Mapping[str, str] | None = None) -> DataFrame:
    """One row per table: ddl (NULL when a type cannot be mapped), counts, long names, ok."""
    mapped = catalog if "tgt_type" in catalog.columns else map_types(catalog)
    mapped = apply_catalog_renames(mapped, renames)
    pairs = [x for src, dst in (table_names or {}).items() for x in (F.lit(src), F.lit(dst))]
    target = F.coalesce(F.create_map(*pairs)[F.col("table_name")], F.col("table_name")) if pairs else F.col("table_name")
    g = mapped.withColumn("_target", target).groupBy("table_name", "_target").agg(
        F.array_sort(F.collect_list(F.struct("ordinal", "field", "tgt_type"))).alias("_cols"),
        F.count(F.lit(1)).cast("bigint").alias("n_columns"),
        F.sum(F.when(F.col("map_status") == "unsupported", 1).otherwise(0)).cast("bigint").alias("n_unsupported"),
        F.sum(F.when(F.col("map_status") == "narrowed", 1).otherwise(0)).cast("bigint").alias("n_narrowed"),
        F.array_sort(F.collect_list(F.when(F.length("field") > max_name_len, F.col("field")))).alias("_long"),
    )
    body = F.array_join(F.transform("_cols", lambda s: F.concat(F.lit('"'), s["field"], F.lit('" '), s["tgt_type"])),
                        ",")
    ddl = F.concat(F.lit(f"create table {schema}."), F.col("_target"), F.lit(" ( "), body, F.lit(" )"))
    long_names = F.when(F.size("_long") == 0, F.lit(None)).otherwise(F.array_join("_long", "|"))
    return g.select(
        "table_name",
        F.when(F.col("n_unsupported") == 0, ddl).alias("ddl"),
        "n_columns", "n_unsupported", "n_narrowed",
        long_names.alias("long_names"),
        ((F.col("n_unsupported") == 0) & (F.col("n_narrowed") == 0) & (F.size("_long") == 0)).alias("ok"),
    )

