"""Source (MySQL-style) column type → warehouse (Oracle-style) column type.

The mapping is evaluated per column on the parsed base type, as one Spark
expression over a column-catalog DataFrame, so a catalog of any size maps in
a single projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The type mapping the warehouse loads must reproduce.
#   varchar(n)                 -> varchar2(1000)   (flagged 'narrowed' when n > 1000)
#   tinyint                    -> number(5,0)
#   smallint                   -> number(7,0)
#   mediumint                  -> number(9,0)
#   bigint                     -> number(24,0)
#   int                        -> number(12,0)
#   double / float / decimal   -> number, or number(p,s) when (p,s) is given
#   datetime                   -> timestamp, or timestamp(n) when (n) is given
#   timestamp[(n)]             -> timestamp
#   bit(1)                     -> number(2,0)
#   text / mediumtext / longtext -> clob
#   long                       -> varchar2(4000)
#   date / char(n) / blob      -> unchanged
#   anything else              -> no mapping ('unsupported')
#   a trailing 'unsigned' is dropped before mapping
VARCHAR_TARGET = "varchar2(1000)"
VARCHAR_MAX_WIDTH = 1000
FIXED_TARGETS = {
    "varchar": VARCHAR_TARGET,
    "tinyint": "number(5,0)",
    "smallint": "number(7,0)",
    "mediumint": "number(9,0)",
    "bigint": "number(24,0)",
    "int": "number(12,0)",
    "text": "clob",
    "mediumtext": "clob",
    "longtext": "clob",
    "long": "varchar2(4000)",
}
NUMERIC_BASES = ("double", "float", "decimal")
KEPT_BASES = ("date", "char", "blob")


def _parts(src: Column) -> tuple[Column, Column, Column]:
    t = F.lower(F.trim(src))
    t = F.trim(F.regexp_replace(t, r"\s+unsigned\b", ""))
    base = F.regexp_extract(t, r"^([a-z0-9_]+)", 1)
    args = F.regexp_replace(F.regexp_extract(t, r"^[a-z0-9_]+\s*\(([^)]*)\)", 1), r"\s+", "")
    return t, base, args


def _target_from_parts(t: Column, base: Column, args: Column) -> Column:
    has_args = args != F.lit("")
    expr = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, target in FIXED_TARGETS.items():
        expr = expr.when(base == name, F.lit(target))
    return (
        expr.when(base.isin(*NUMERIC_BASES),
                  F.when(has_args, F.concat(F.lit("number("), args, F.lit(")"))).otherwise(F.lit("number")))
        .when(base == "datetime",
              F.when(has_args, F.concat(F.lit("timestamp("), args, F.lit(")"))).otherwise(F.lit("timestamp")))
        .when(base == "timestamp", F.lit("timestamp"))
        .when((base == "bit") & (args == "1"), F.lit("number(2,0)"))
        .when(base.isin(*KEPT_BASES), t)
    )


def _status_from_parts(tgt: Column, base: Column, args: Column) -> Column:
    width = F.when(args.rlike(r"^[0-9]+$"), args.cast("bigint"))
    return (
        F.when(tgt.isNull(), F.lit("unsupported"))
        .when((base == "varchar") & (width > VARCHAR_MAX_WIDTH), F.lit("narrowed"))
        .otherwise(F.lit("ok"))
    )


def mapped_type(src: Column) -> Column:
    """Target type for a source-type column; NULL when there is no mapping."""
    return _target_from_parts(*_parts(src))


def map_types(catalog: DataFrame, type_col: str = "src_type") -> DataFrame:
    """Add ``tgt_type`` and ``map_status`` ('ok' | 'narrowed' | 'unsupported').

    The type text is parsed once into helper columns that the mapping then
    references, keeping the generated code small.
    """
    t, base, args = _parts(F.col(type_col))
    parsed = catalog.withColumns({"_tm_t": t, "_tm_base": base, "_tm_args": args})
    tb, bb, ab = F.col("_tm_t"), F.col("_tm_base"), F.col("_tm_args")
    mapped = parsed.withColumn("tgt_type", _target_from_parts(tb, bb, ab))
    return mapped.withColumn("map_status", _status_from_parts(F.col("tgt_type"), bb, ab)).drop(
        "_tm_t", "_tm_base", "_tm_args")
