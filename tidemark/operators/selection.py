"""The rows at given places of a table's key order, without sorting the table.

``select_range`` narrows the key interval that holds the wanted places by range histograms: one pass counts the rows
of some thousand bins of the interval (a task sends one row a bin, the driver gets one row a bin), the bins
that hold the first and last place give the next interval, as keys of the rows themselves, so that the bounds are
exact in the key's own type and reach the scan as filters. It ends when the interval holds little more than was
asked for. Bins only have to follow the key's order; how they are cut decides the number of passes, not the result:

* numbers, dates and timestamps by their distance from the interval's start;
* text by the bytes after the prefix that the interval's ends share;
* rows that share one key (or have none) by their row hash.

The order is NULLs first, then key, then row hash, as ``positions`` has it.
"""

from __future__ import annotations

import os.path
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 4096
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def selectable(kind: T.DataType) -> bool:
    """Key types whose order a bin can follow."""
    if isinstance(kind, T.StringType):
        return kind.collation == "UTF8_BINARY"
    return isinstance(kind, (*_NUMBERS, *_TIMES))


@dataclass(frozen=True)
class Found:
    """Rows that surely hold the wanted places: a condition, how many rows it has and how many lie before them."""

    condition: Column
    n: int
    before: int


def _as_number(key: Column, kind: T.DataType, low, high) -> Column:
    """A number that never falls when the key rises, within [low, high]."""
    if isinstance(kind, T.StringType):
        a, b = low.encode(), high.encode()
        shared = len(os.path.commonprefix([a, b]))
        piece = F.substring(key.cast("binary"), shared + 1, 6)
        return F.conv(F.rpad(F.hex(piece), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(key).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(key).cast("double") - F.unix_micros(F.lit(low).cast(kind))
    if isinstance(kind, T.TimestampNTZType):  # by its own clock: no time zone may fold it
        seconds = F.unix_date(key.cast("date")) * F.lit(86400) + F.hour(key) * 3600 + F.minute(key) * 60
        return seconds.cast("double") + F.extract(F.lit("SECOND"), key).cast("double")
    if isinstance(kind, T.DecimalType):
        return (key - F.lit(low).cast(kind)).cast("double")
    return (key.cast("decimal(20,0)") - F.lit(int(low)).cast("decimal(20,0)")).cast("double")


def _histogram(rows: DataFrame, value: Column, key: Column, low: float, high: float) -> list:
    """``(bin, n, lo, hi)`` of the bins that hold rows, in order; lo and hi are keys."""
    width = (high - low) / BINS
    place = F.least(F.greatest(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(0)), F.lit(BINS - 1)) if width > 0 else F.lit(0)
    return (rows.groupBy(place.cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).orderBy("bin").collect())  # BINS rows at most


def _covering(bins: list, first: int, last: int) -> tuple[int, int, int]:
    """First and last of the bins that hold the places, and the rows before them."""
    before, start, skipped = 0, None, 0
    for i, b in enumerate(bins):
        if start is None and before + b["n"] > first:
            start, skipped = i, before
        before += b["n"]
        if before > last:
            return start, i, skipped
    return (len(bins) if start is None else start), len(bins) - 1, skipped


def _narrowed(rows: DataFrame, key: Column, kind: T.DataType, low, high, n: int, first: int, last: int, enough: int) -> tuple:
    """``(low, high, n, before)`` of the smallest interval found for the places among ``rows`` (n of them, from low to high)."""
    before = 0
    while n > enough and low != high:
        value = _as_number(key, kind, low, high)
        ends = rows.sparkSession.range(1).select(*[_as_number(F.lit(x).cast(kind), kind, low, high).alias(name) for x, name in ((low, "a"), (high, "b"))]).first()
        inside = rows.where((key >= F.lit(low).cast(kind)) & (key <= F.lit(high).cast(kind)))
        bins = _histogram(inside, value, key, ends["a"], ends["b"])
        start, stop, skipped = _covering(bins, first - before, last - before)
        left = sum(b["n"] for b in bins[start:stop + 1])
        if left == n and bins[start]["lo"] == low and bins[stop]["hi"] == high:
            break  # bins cut it no finer
        low, high, n, before = bins[start]["lo"], bins[stop]["hi"], left, before + skipped
    return low, high, n, before


def select_range(df: DataFrame, key: str, row_hash: Column, first: int, last: int, enough: int) -> Found | None:
    """Where the rows at places ``first`` to ``last`` (0-based) of the key order are; None beyond the table's end."""
    k, kind = F.col("`" + key.replace("`", "``") + "`"), df.schema[key].dataType
    ends = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(k.isNull()).alias("nulls"), F.min(k).alias("lo"), F.max(k).alias("hi")).first()
    last = min(last, ends["n"] - 1)
    if first > last:
        return None
    nulls = ends["nulls"]
    if first < nulls <= last or nulls and nulls <= enough and first < nulls:  # on both sides: the nulls and what follows
        if nulls > enough:
            head = _by_hash(df, k.isNull(), row_hash, nulls, first, nulls - 1, enough)
        else:
            head = Found(k.isNull(), nulls, 0)
        if last < nulls:
            return head
        tail = select_among(df, k, kind, row_hash, ends["lo"], ends["hi"], ends["n"] - nulls, 0, last - nulls, enough)
        return Found(head.condition | tail.condition, head.n + tail.n, head.before)
    if first < nulls:
        return _by_hash(df, k.isNull(), row_hash, nulls, first, last, enough)
    found = select_among(df, k, kind, row_hash, ends["lo"], ends["hi"], ends["n"] - nulls, first - nulls, last - nulls, enough)
    return Found(found.condition, found.n, found.before + nulls)


def select_among(df: DataFrame, k: Column, kind: T.DataType, row_hash: Column, low, high, n: int, first: int, last: int, enough: int) -> Found:
    low, high, n, before = _narrowed(df, k, kind, low, high, n, first, last, enough)
    condition = (k >= F.lit(low).cast(kind)) & (k <= F.lit(high).cast(kind))
    if n > enough and low == high:  # one key has them all
        found = _by_hash(df, condition, row_hash, n, first - before, last - before, enough)
        return Found(found.condition, found.n, found.before + before)
    return Found(condition, n, before)


def _by_hash(df: DataFrame, condition: Column, row_hash: Column, n: int, first: int, last: int, enough: int) -> Found:
    """Among rows of one key (or none): by their hashes."""
    rows = df.where(condition).select(row_hash.alias("_h"))
    h = F.col("_h")
    low, high, n, before = _narrowed(rows, h, T.LongType(), -(1 << 63), (1 << 63) - 1, n, first, last, enough)
    return Found(condition & (row_hash >= F.lit(low)) & (row_hash <= F.lit(high)), n, before)


def counted_ranges(df: DataFrame, key: str, rows_per_range: int) -> list[tuple]:
    """``(lo, hi, n)`` of disjoint key intervals that cover the table, in order; ``(None, None, n)`` first if keys are NULL.

    Bins of a histogram are joined up to ``rows_per_range`` rows; one that holds more is cut again, as long as it holds
    several keys: no sort, no window over the table, a row a bin for the driver."""
    k, kind = F.col("`" + key.replace("`", "``") + "`"), df.schema[key].dataType
    if not selectable(kind):
        raise ValueError(f"{key}: a {kind.simpleString()} key has no ranges")
    rows = df.select(k.alias("_k"))
    k = F.col("_k")
    ends = rows.agg(F.count_if(k.isNull()).alias("nulls"), F.min(k).alias("lo"), F.max(k).alias("hi"), F.count(k).alias("n")).first()
    out: list[tuple] = [(None, None, ends["nulls"])] if ends["nulls"] else []
    todo = [(ends["lo"], ends["hi"], ends["n"])] if ends["n"] else []
    done: list[tuple] = []
    while todo:
        low, high, n = todo.pop()
        if n <= rows_per_range or low == high:
            done.append((low, high, n))
            continue
        sides = [_as_number(F.lit(x).cast(kind), kind, low, high) for x in (low, high)]
        a, b = df.sparkSession.range(1).select(sides[0].alias("a"), sides[1].alias("b")).first()
        inside = rows.where((k >= F.lit(low).cast(kind)) & (k <= F.lit(high).cast(kind)))
        bins = [(x["lo"], x["hi"], x["n"]) for x in _histogram(inside, _as_number(k, kind, low, high), k, a, b)]
        if bins == [(low, high, n)]:
            done.append((low, high, n))  # keys that no bin tells apart
        else:
            todo += bins
    for low, high, n in sorted(done, key=lambda r: r[0]):
        if out and out[-1][0] is not None and out[-1][2] + n <= rows_per_range:
            out[-1] = (out[-1][0], high, out[-1][2] + n)
        else:
            out.append((low, high, n))
    return out
