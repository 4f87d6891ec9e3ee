"""JDBC sources and sinks (MySQL-style sources, Oracle-style warehouses).

Reads are parallel whenever a numeric/date key is named: Spark splits
``[lower, upper]`` into ``num_partitions`` strides and each task reads one
``WHERE key >= a AND key < b`` slice (a plain JDBC read is one task). Bounds
come from one pushed-down ``min/max`` query when not given. Row filters are
written as DataFrame predicates; Catalyst pushes them into the JDBC query.

Writes reuse ``numPartitions`` (Spark coalesces to it) and ``batchsize``;
``truncate`` keeps the target's DDL on overwrite.

A set-based swap (DELETE by the staged keys, INSERT the stage) is SQL the
warehouse runs itself; ``swap_statements`` writes that SQL for a staging table
filled by ``write_jdbc``.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions.lists import key_list

MYSQL_ZERO_DATES = "zeroDateTimeBehavior=convertToNull"
DEFAULT_FETCH_SIZE = 10_000
DEFAULT_BATCH_SIZE = 10_000


def with_zero_dates_as_null(url: str) -> str:
    """MySQL URLs get ``zeroDateTimeBehavior=convertToNull`` (0000-00-00 → NULL)."""
    if not url.startswith("jdbc:mysql:") or "zeroDateTimeBehavior" in url:
        return url
    return url + ("&" if "?" in url else "?") + MYSQL_ZERO_DATES


def jdbc_read_options(url: str, table: str | None = None, *, query: str | None = None,
                      user: str | None = None, password: str | None = None, driver: str | None = None,
                      partition_column: str | None = None, lower_bound=None, upper_bound=None,
                      num_partitions: int | None = None, fetch_size: int = DEFAULT_FETCH_SIZE,
                      zero_dates_to_null: bool = True, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    opts: dict[str, str] = {"url": with_zero_dates_as_null(url) if zero_dates_to_null else url,
                            "fetchsize": str(fetch_size)}
    if table is not None:
        opts["dbtable"] = table
    else:
        # a sub-query works with partitioned reads too (``query`` does not).
        opts["dbtable"] = f"({query}) tidemark_q"
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partitioned read needs lower_bound, upper_bound and num_partitions")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                     "upperBound": str(upper_bound), "numPartitions": str(int(num_partitions))})
    opts.update({k: str(v) for k, v in (extra or {}).items()})
    return opts


def key_bounds(spark: SparkSession, url: str, table: str, key: str, **conn) -> tuple:
    """``(min, max)`` of a key, computed by the database (one small row)."""
    q = f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}"
    row = spark.read.format("jdbc").options(**jdbc_read_options(url, query=q, **conn)).load().first()
    return (row[0], row[1]) if row is not None else (None, None)


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, *, query: str | None = None,
              predicate: Column | str | None = None, key: str | None = None, num_partitions: int | None = None,
              lower_bound=None, upper_bound=None, user: str | None = None, password: str | None = None,
              driver: str | None = None, fetch_size: int = DEFAULT_FETCH_SIZE, zero_dates_to_null: bool = True,
              extra: Mapping[str, str] | None = None) -> DataFrame:
    conn = {"user": user, "password": password, "driver": driver}
    if key is not None and num_partitions and num_partitions > 1:
        if lower_bound is None or upper_bound is None:
            lower_bound, upper_bound = key_bounds(spark, url, table or f"({query}) tidemark_b", key, **conn)
        if lower_bound is None:  # empty table: one partition is enough
            key = None
    opts = jdbc_read_options(
        url, table, query=query, partition_column=key if key and num_partitions and num_partitions > 1 else None,
        lower_bound=lower_bound, upper_bound=upper_bound, num_partitions=num_partitions, fetch_size=fetch_size,
        zero_dates_to_null=zero_dates_to_null, extra=extra, **conn)
    df = spark.read.format("jdbc").options(**opts).load()
    return df.filter(predicate) if predicate is not None else df


def jdbc_write_options(url: str, table: str, *, user: str | None = None, password: str | None = None,
                       driver: str | None = None, truncate: bool = False, num_partitions: int | None = None,
                       batch_size: int = DEFAULT_BATCH_SIZE, column_types: str | None = None,
                       isolation_level: str | None = None) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if truncate:
        opts["truncate"] = "true"
    if num_partitions:
        opts["numPartitions"] = str(int(num_partitions))
    if column_types:
        opts["createTableColumnTypes"] = column_types
    if isolation_level:
        opts["isolationLevel"] = isolation_level
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, *, mode: str = "append", truncate: bool = False,
               num_partitions: int | None = 20, **kw) -> None:
    """Write rows to a JDBC table (``overwrite`` + ``truncate`` keeps its DDL)."""
    if mode not in ("append", "overwrite", "error", "errorifexists", "ignore"):
        raise ValueError(f"unknown save mode {mode!r}")
    opts = jdbc_write_options(url, table, truncate=truncate, num_partitions=num_partitions, **kw)
    df.write.format("jdbc").mode(mode).options(**opts).save()


def staging_name(target: str) -> str:
    """A staging table of its own for each swap, so that two swaps can't share one."""
    return f"{target}_{uuid.uuid4().hex[:8]}"


def drop_statement(table: str) -> str:
    return f"DROP TABLE {table}"


def swap_statements(target: str, staging: str, keys: str | Iterable[str],
                    columns: Iterable[str] | None = None) -> list[str]:
    """Set-based swap run by the warehouse: DELETE by staged keys, INSERT the stage."""
    ks = key_list(keys)
    klist = ", ".join(f'"{k}"' for k in ks)
    if columns is None:
        insert = f"INSERT INTO {target} SELECT * FROM {staging}"
    else:
        cols = ", ".join(f'"{c}"' for c in columns)
        insert = f"INSERT INTO {target} ({cols}) SELECT {cols} FROM {staging}"
    return [f"DELETE FROM {target} WHERE ({klist}) IN (SELECT {klist} FROM {staging})", insert]


def range_predicates(key: str, bounds: Iterable) -> list[str]:
    """Disjoint WHERE clauses covering every row: ``key <= b1``, ``b1 < key <= b2``, …,
    ``key > bn``, and ``key IS NULL``. ``bounds`` are numbers, dates or timestamps (duplicates
    dropped); texts are refused, since their order is the database's collation."""
    bs = sorted({b for b in bounds if b is not None})
    if any(isinstance(b, bool) or not isinstance(b, (int, float, Decimal, datetime.date)) for b in bs):
        raise TypeError(f"range predicates need numeric or temporal keys, {key} has bounds like {bs[0]!r}")

    def lit(v) -> str:
        if isinstance(v, datetime.datetime):
            return f"'{v.isoformat(sep=' ')}'"
        if isinstance(v, datetime.date):
            return f"'{v.isoformat()}'"
        return repr(v) if isinstance(v, float) else str(v)

    if not bs:
        return [f"{key} IS NOT NULL", f"{key} IS NULL"]
    preds = [f"{key} <= {lit(bs[0])}"]
    preds += [f"{key} > {lit(lo)} AND {key} <= {lit(hi)}" for lo, hi in zip(bs, bs[1:])]
    preds += [f"{key} > {lit(bs[-1])}", f"{key} IS NULL"]
    return preds


def ntile_bounds_query(table: str, key: str, n: int) -> str:
    """Upper key of each of ``n`` equal-row tiles, computed by the database."""
    return (f"SELECT MAX({key}) AS hi FROM (SELECT {key}, NTILE({int(n)}) OVER (ORDER BY {key}) AS tile "
            f"FROM {table} WHERE {key} IS NOT NULL) tiles GROUP BY tile")


def splittable_field(df: DataFrame, key: str | None) -> str | None:
    """The column named ``key`` (in any case) if a read can be split by it: numeric or temporal."""
    kinds = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType, T.TimestampType,
             T.TimestampNTZType)
    return next((f.name for f in df.schema.fields
                 if f.name.lower() == (key or "").lower() and isinstance(f.dataType, kinds)), None)


def read_jdbc_balanced(spark: SparkSession, url: str, table: str, key: str, num_partitions: int, *,
                       user: str | None = None, password: str | None = None, driver: str | None = None,
                       fetch_size: int = DEFAULT_FETCH_SIZE, zero_dates_to_null: bool = True) -> DataFrame:
    """Parallel read with equal-row partitions, whatever the key's distribution.

    Stride partitioning (``partitionColumn``) splits the key *range* evenly, so
    sparse or skewed keys give a few huge partitions. Here the database computes
    ``num_partitions`` row-count tiles of the key (one query, ``num_partitions``
    small rows back) and each Spark task reads one tile by a WHERE predicate;
    NULL keys get their own partition.
    """
    conn = {"user": user, "password": password, "driver": driver}
    plain = read_jdbc(spark, url, table, fetch_size=fetch_size, zero_dates_to_null=zero_dates_to_null, **conn)
    if num_partitions <= 1 or splittable_field(plain, key) is None:
        return plain
    q = ntile_bounds_query(table, key, num_partitions)
    rows = spark.read.format("jdbc").options(
        **jdbc_read_options(url, query=q, zero_dates_to_null=zero_dates_to_null, **conn)).load().collect()
    preds = range_predicates(key, [r[0] for r in rows][:-1] if rows else [])
    props = {k: v for k, v in {"user": user, "password": password, "driver": driver,
                               "fetchsize": str(fetch_size)}.items() if v is not None}
    target_url = with_zero_dates_as_null(url) if zero_dates_to_null else url
    return spark.read.jdbc(target_url, table, predicates=preds, properties=props)


def read_jdbc_parallel(spark: SparkSession, url: str, table: str, key: str | None, num_partitions: int, *,
                       user: str | None = None, password: str | None = None, driver: str | None = None,
                       fetch_size: int = DEFAULT_FETCH_SIZE, zero_dates_to_null: bool = True) -> DataFrame:
    """A key-partitioned read when ``key`` is numeric or temporal (its type comes
    from the table's schema, no data is read), else one partition."""
    conn = {"user": user, "password": password, "driver": driver}
    plain = read_jdbc(spark, url, table, fetch_size=fetch_size, zero_dates_to_null=zero_dates_to_null, **conn)
    name = splittable_field(plain, key)
    if name is None or num_partitions <= 1:
        return plain
    return read_jdbc(spark, url, table, key=name, num_partitions=num_partitions, fetch_size=fetch_size,
                     zero_dates_to_null=zero_dates_to_null, **conn)
