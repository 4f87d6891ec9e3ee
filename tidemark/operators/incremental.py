"""Picking out changed rows.

``incremental_filter`` keeps rows where *any* listed time column is at or
after the watermark (inclusive; a NULL time never matches). The bound is a
literal of each column's type, so the predicate is pushed to the scan.

``incremental_join`` is the same filter over a join whose time columns sit on
both sides. Instead of joining the two whole tables and filtering after, it
joins each side's *slice* with the other whole side and unions the two
results (OR-expansion), so the big-to-big shuffle join becomes two
slice-to-table joins that broadcast the (size-checked) slice.

``zero_dates_to_null`` turns MySQL zero dates (``0000-00-00 …``) kept as text
into NULL while parsing the rest strictly.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.lists import key_list
from tidemark.functions.watermark import parse_run_date, watermark_bound
from tidemark.operators.sizing import DEFAULT_BROADCAST_ROWS, checked_broadcast

ZERO_DATE_PREFIX = "0000-00-00"
DEFAULT_DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def time_predicate(df: DataFrame, time_cols: str | Iterable[str], watermark: str, unit: str = "s",
                   tz: str = "UTC") -> Column:
    cols = key_list(time_cols)
    case_sensitive = str(df.sparkSession.conf.get("spark.sql.caseSensitive", "false")).lower() == "true"

    def norm(name: str) -> str:
        return name if case_sensitive else name.lower()

    fields = {norm(f.name): f for f in df.schema.fields}
    missing = [c for c in cols if norm(c) not in fields]
    if missing:
        raise ValueError(f"time columns {missing} not in {df.columns}")
    preds = [F.col(_q(fields[norm(c)].name)) >= watermark_bound(fields[norm(c)].dataType, watermark, unit, tz)
             for c in cols]
    return reduce(lambda a, b: a | b, preds)


def incremental_filter(df: DataFrame, time_cols: str | Iterable[str], watermark: str, unit: str = "s",
                       overlap_days: int = 0, tz: str = "UTC") -> DataFrame:
    """Rows with any time column ``>=`` the watermark (minus an optional overlap).

    A row changed before the watermark but arriving later is never picked up
    (at-least-once from the watermark on); pass ``overlap_days`` to re-read a
    few days and let the key upsert absorb the repeats.
    """
    wm = parse_run_date(watermark)
    if overlap_days:
        import datetime as _dt
        wm = (_dt.date.fromisoformat(wm) - _dt.timedelta(days=int(overlap_days))).isoformat()
    return df.filter(time_predicate(df, time_cols, wm, unit, tz))


def incremental_join(left: DataFrame, right: DataFrame, on: str | Iterable[str],
                     left_time_cols: str | Iterable[str], right_time_cols: str | Iterable[str],
                     watermark: str, unit: str = "s", tz: str = "UTC",
                     broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``left ⋈ right`` restricted to rows where any time column is ``>=`` the watermark.

    = (left ⋈ right_slice) ∪ (left_slice ⋈ right where NOT right_due). The
    second branch excludes rows the first already produced, so the union is
    exact without a distinct. Join keys are equi-join columns present on both
    sides under the same name.
    """
    ks = key_list(on)
    r_due = time_predicate(right, right_time_cols, watermark, unit, tz)
    l_due = time_predicate(left, left_time_cols, watermark, unit, tz)
    right_slice = right.filter(r_due)
    left_slice = left.filter(l_due)
    first = left.join(checked_broadcast(right_slice, broadcast_rows), ks, "inner")
    # NOT (r_due) must be NULL-safe: a NULL time is "not due".
    right_rest = right.filter(~F.coalesce(r_due, F.lit(False)))
    second = checked_broadcast(left_slice, broadcast_rows).join(right_rest, ks, "inner")
    return first.unionByName(second)


def zero_dates_to_null(df: DataFrame, cols: str | Iterable[str], fmt: str = DEFAULT_DATETIME_FORMAT,
                       to: str = "timestamp_ntz") -> DataFrame:
    """Parse text date columns; ``0000-00-00…`` becomes NULL, bad text still fails."""
    out = {}
    for c in key_list(cols):
        s = F.trim(F.col(_q(c)))
        parsed = F.to_timestamp_ntz(s, F.lit(fmt)) if to == "timestamp_ntz" else F.to_timestamp(s, fmt)
        if to == "date":
            parsed = F.to_date(s, fmt)
        bad = F.raise_error(F.concat(F.lit(f"{c}: not a date: "), s)).cast(to)  # also where the session isn't ANSI
        out[c] = (F.when(s.startswith(ZERO_DATE_PREFIX), F.lit(None))
                  .when(s.isNotNull() & parsed.isNull(), bad).otherwise(parsed))
    return df.withColumns(out)
