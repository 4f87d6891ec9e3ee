"""Merge-on-read deltas of a keyed lake table.

Beside its base files a table may have delta folders, one a commit, and a log that names them:

* ``_deltas/_seq=<n>/_b=<bucket>/`` holds the rows of commit *n* (or the keys it deletes, with ``_gone``);
* ``_delta_log`` has one small row a commit: its number, its kind, rows per bucket, and the caller's tag. A commit counts once
  its row is there, which is one file moved into place: a write that fails leaves a folder that nobody reads and the
  next commit replaces.

An upsert therefore writes its own rows and nothing else. Readers resolve: a row counts if no later commit has its key
(rows with a NULL key never match, so they always count; equal keys inside one commit are all kept). Base rows of buckets
without deltas are read as they are; in the others the base is anti-joined with the delta keys, which are broadcast where the log
proves them few, so the base is not shuffled.

``compacted`` entries (kind ``base``) replace buckets: their folder holds a bucket's whole content up to that commit.
Splits of buckets (``lake.split_lake``) are noted in the commit that holds the new buckets' rows.
The log is the only place where anything is switched, so readers see a commit wholly or not at all. One
writer at a time is assumed, as for the rest of the table.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tidemark.operators.keys import all_present, any_null
from tidemark.operators.upsert import delete_by_keys

DATA_DIR, LOG_DIR = "_deltas", "_delta_log"
SEQ, GONE = "_seq", "_gone"
LOG_SCHEMA = "seq int, kind string, buckets array<bigint>, rows array<bigint>, whole boolean, tag string, splits array<array<bigint>>"


@dataclass(frozen=True)
class Commit:
    """``kind`` is ``delta`` or ``base``; ``rows`` counts by bucket; ``whole``: a base of all buckets, named or not;
    ``splits``: (level, bucket) pairs that the commit divides."""

    seq: int
    kind: str
    rows: dict[int, int]
    whole: bool = False
    tag: str | None = None
    splits: tuple[tuple[int, int], ...] = ()


def read_log(spark: SparkSession, path: str) -> list[Commit]:
    """All commits, in order; none for a table without deltas."""
    try:
        rows = spark.read.schema(LOG_SCHEMA).json(f"{path.rstrip('/')}/{LOG_DIR}").collect()  # one small row a commit
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((Commit(r["seq"], r["kind"], dict(zip(r["buckets"], r["rows"], strict=True)), bool(r["whole"]), r["tag"],
                          tuple((level, b) for level, b in r["splits"] or [])) for r in rows),
                  key=lambda c: c.seq)


def write_commit(spark: SparkSession, path: str, commit: Commit) -> None:
    row = (commit.seq, commit.kind, list(commit.rows), list(commit.rows.values()), commit.whole, commit.tag, [list(x) for x in commit.splits])
    spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/{LOG_DIR}")


def delta_path(path: str, seq: int) -> str:
    return f"{path.rstrip('/')}/{DATA_DIR}/{SEQ}={seq}"


def next_seq(log: list[Commit]) -> int:
    return log[-1].seq + 1 if log else 1


@dataclass(frozen=True)
class State:
    """What the log says about each bucket: the commit that holds its base (0: the table's own files), and later deltas."""

    replaced: dict[int, int]  # bucket → commit, for buckets with a newer base
    whole: int  # commit that replaced all buckets at once, 0 if none
    deltas: list[Commit]

    @classmethod
    def of(cls, log: list[Commit]) -> State:
        whole = max((c.seq for c in log if c.kind == "base" and c.whole), default=0)
        replaced = {b: c.seq for c in log if c.kind == "base" and c.seq > whole for b in c.rows}
        return cls(replaced, whole, [c for c in log if c.kind == "delta" and c.seq > whole])

    def base_of(self, bucket: int) -> int:
        return self.replaced.get(bucket, self.whole)

    def pending(self) -> dict[int, int]:
        """Delta rows that readers resolve, by bucket."""
        out: dict[int, int] = {}
        for c in self.deltas:
            for b, n in c.rows.items():
                if c.seq > self.base_of(b):
                    out[b] = out.get(b, 0) + n
        return out

    def used(self) -> set[int]:
        """Commits whose folders are still read."""
        pending = {c.seq for c in self.deltas if any(c.seq > self.base_of(b) for b in c.rows)}
        return pending | set(self.replaced.values()) | ({self.whole} - {0})

    def is_live(self, bucket: Column, seq: Column) -> Column:
        """Condition on delta rows: theirs is a commit after their bucket's base."""
        by_base: dict[int, list[int]] = {}
        for b, s in self.replaced.items():
            by_base.setdefault(s, []).append(b)
        after = lambda s: [c.seq for c in self.deltas if c.seq > s]
        parts = [bucket.isin(bs) & seq.isin(after(s)) for s, bs in by_base.items()]
        return reduce(lambda a, b: a | b, parts, ~bucket.isin(list(self.replaced)) & seq.isin(after(self.whole)))

    def is_base(self, bucket: Column, seq: Column) -> Column:
        """Condition on the rows of replacing folders."""
        by_base: dict[int, list[int]] = {}
        for b, s in self.replaced.items():
            by_base.setdefault(s, []).append(b)
        parts = [(seq == s) & bucket.isin(bs) for s, bs in by_base.items()]
        first = (seq == self.whole) & ~bucket.isin(list(self.replaced)) if self.whole else F.lit(False)
        return reduce(lambda a, b: a | b, parts, first)


def _quoted(keys: Iterable[str]) -> list[Column]:
    return [F.col("`" + k.replace("`", "``") + "`") for k in keys]


def resolved(spark: SparkSession, path: str, table: DataFrame, keys: list[str], bucket_col: str, log: list[Commit], *,
             fmt: str, broadcast_rows: int, buckets: Iterable[int] | None = None) -> DataFrame:
    """The table's rows (with their bucket) as the log has them, of all buckets or the given ones.

    ``table`` is the table's own files as a DataFrame."""
    state = State.of(log)
    b, seq = F.col(bucket_col), F.col(SEQ)
    kind = table.schema[bucket_col].dataType
    data = [f for f in table.schema.fields if f.name != bucket_col]
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in data], T.StructField(GONE, T.BooleanType()),
                           T.StructField(SEQ, T.IntegerType()), T.StructField(bucket_col, kind)])
    names = [*[f.name for f in data], bucket_col]
    chosen = (lambda df: df) if buckets is None else (lambda df: df.where(b.isin(list(buckets))))
    pending = {x: n for x, n in state.pending().items() if buckets is None or x in set(buckets)}
    own = table.select(*_quoted(names)) if not state.whole else table.where(F.lit(False)).select(*_quoted(names))
    base = chosen(own.where(~b.isin(list(state.replaced))) if state.replaced else own)
    if not log:
        return base
    stored = spark.read.format(fmt).schema(schema).load(f"{path.rstrip('/')}/{DATA_DIR}")
    if state.replaced or state.whole:
        base = base.unionByName(chosen(stored.where(state.is_base(b, seq))).select(*_quoted(names)))
    if not pending:
        return base
    small = sum(pending.values()) <= broadcast_rows  # the log has counted them
    touched = list(pending)
    delta = stored.where(b.isin(touched)).where(state.is_live(b, seq))
    changed = delete_by_keys(base.where(b.isin(touched)), delta, keys, broadcast_rows=broadcast_rows, small=small)
    if sum(any(x in pending for x in c.rows) for c in state.deltas) > 1:
        last = delta.where(all_present(keys)).groupBy(*_quoted(keys)).agg(F.max(seq).alias("_last"))
        last = last.select(*[c.alias(f"_k{i}") for i, c in enumerate(_quoted(keys))], "_last")
        last = F.broadcast(last) if small else last
        same = reduce(lambda x, y: x & y, [c == F.col(f"_k{i}") for i, c in enumerate(_quoted(keys))])
        newest = delta.where(all_present(keys)).join(last, same & (seq == F.col("_last")), "left_semi")
        delta = newest.unionByName(delta.where(any_null(keys)))
    rows = delta.where(~F.coalesce(F.col(GONE), F.lit(False))).select(*_quoted(names))
    return base.where(~b.isin(touched)).unionByName(changed).unionByName(rows)
