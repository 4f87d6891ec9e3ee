"""Typed lower bounds for watermark (``yyyy-MM-dd``) comparisons.

A watermark is the date of the last successful load. A row is due when any of
its time columns is at or after that date. The bound is a literal of the
column's own type so the comparison stays a plain predicate that Catalyst
folds and pushes to the scan (parquet row-group skipping, JDBC WHERE):

* DATE                       → DATE literal
* TIMESTAMP / TIMESTAMP_NTZ  → midnight of the date, same type
* integral (epoch numbers)   → seconds (``unit="s"``) or milliseconds (``"ms"``)
  since 1970-01-01 of midnight in ``tz`` (default UTC; the source's clock),
  computed here as a literal so the session time zone never shifts it
* string (ISO text)          → the date text itself (ISO text sorts by time)
"""

from __future__ import annotations

import datetime as _dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WATERMARK_FORMAT = "yyyy-MM-dd"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def parse_run_date(value: str | _dt.date) -> str:
    """Validate a ``yyyy-MM-dd`` date and return it as text."""
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, _dt.date):
        return value.isoformat()
    try:
        return _dt.date.fromisoformat(str(value).strip()).isoformat()
    except ValueError as exc:
        raise ValueError(f"watermark/run date must be yyyy-MM-dd, got {value!r}") from exc


def epoch_of(watermark: str, tz: str = "UTC") -> int:
    """Seconds since 1970-01-01T00:00Z of midnight of ``watermark`` in ``tz``."""
    d = _dt.date.fromisoformat(parse_run_date(watermark))
    return int(_dt.datetime(d.year, d.month, d.day, tzinfo=ZoneInfo(tz)).timestamp())


def watermark_bound(dtype: T.DataType, watermark: str, unit: str = "s", tz: str = "UTC") -> Column:
    """Literal lower bound for a column of ``dtype``."""
    wm = parse_run_date(watermark)
    if isinstance(dtype, T.DateType):
        return F.lit(wm).cast("date")
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(wm).cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return F.lit(wm).cast("timestamp")
    if isinstance(dtype, _INTEGRAL) or isinstance(dtype, T.DecimalType):
        secs = epoch_of(wm, tz)
        if unit == "s":
            return F.lit(secs)
        if unit == "ms":
            return F.lit(secs * 1000)
        raise ValueError(f"epoch unit must be 's' or 'ms', got {unit!r}")
    if isinstance(dtype, T.StringType):
        return F.lit(wm)
    raise TypeError(f"cannot compare a {dtype.simpleString()} column with a watermark")
