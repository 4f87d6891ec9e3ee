"""Size checks before broadcasting.

A side is broadcast only after one aggregation proves its size: its rows and an upper
estimate of its bytes (lengths of text, binary and nested columns, fixed widths for the
rest). The aggregation is partial first: every task sends one row. Above the bound the
join is left to Catalyst/AQE (sort-merge or shuffled hash, with AQE skew splitting).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Key sides of a few million rows are a few tens of MB once broadcast.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20
_ROW_BYTES = 16


def row_bytes(df: DataFrame) -> Column:
    """Upper estimate of a row's bytes in a hashed relation."""
    parts = [F.lit(_ROW_BYTES + 8 * len(df.columns))]
    for f in df.schema.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)))
        elif isinstance(f.dataType, T.DecimalType):
            parts.append(F.lit(16))
    return reduce(lambda a, b: a + b, parts)


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df``, by one aggregation."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()
    return int(r["n"]), int(r["b"])


def at_most(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes."""
    if max_rows <= 0:
        return False
    n, b = measured(df)
    return n <= max_rows and b <= max_bytes


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when it is proven small, ``df`` unchanged otherwise."""
    return F.broadcast(df) if at_most(df, max_rows, max_bytes) else df


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()
