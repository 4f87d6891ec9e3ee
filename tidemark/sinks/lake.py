"""Lake tables: file tables (parquet by default) kept up to date by key.

Layout: a keyed lake table is partitioned by ``_b = pmod(xxhash64(keys), N)`` or,
for one integral key, by ``_b = floor(key / width)``. The layout (key order, N or
width) is stored beside the data in ``_layout`` and read back by every upsert, swap
and delete, so a caller cannot address the wrong buckets; other key columns than
the stored ones are refused. N is chosen from the table's size unless given.

With ``as_delta`` an upsert writes only its own rows, as a delta that readers resolve (``deltas.py``), and
``compact_lake`` merges the worst buckets later. Otherwise it rewrites the buckets it must:

1. the source (an incremental slice, usually small) is persisted; its rows,
   keyed rows and distinct keys per bucket (at most N small rows) are
   collected: they name the touched buckets, prove the broadcast bound and
   say whether the duplicate-key probe of a MERGE is needed;
2. the key columns of the touched buckets are probed with the slice's keys: only
   buckets that hold a matching key are rewritten; the others hold nothing to
   update and get the slice's rows appended as new files (a second commit: between the two, readers see
   half a slice). Where three quarters of the touched buckets have a match, all are rewritten, in one commit;
3. the buckets to rewrite are read with ``_b IN (...)`` (partition pruning);
   merged = target anti-join source keys + source, written back with dynamic
   partition overwrite.

``delete_from_lake`` works the same way on a key list, and clears buckets
that the delete empties (a dynamic overwrite would leave them untouched).
An upsert into a table that is not there fails: creating a table from a slice would
lose the rows before it. ``create=True`` says that the source is complete.

Writes use the ``rebalance`` hint on ``_b``: AQE makes output partitions of a
sensible size and splits a bucket that holds a hot key (a third of the rows),
so no single task writes a whole skewed bucket.

With hash buckets k changed keys rewrite at most k buckets of N; sources with
auto-increment keys (recent changes cluster near the largest ids) can use the
key-range layout, where they share the few newest ranges. (NULL keys go to bucket
-1; a shared bucket id is harmless, the bucket only groups rows.) The width should be
chosen so that the key range makes no more buckets than a driver-side list can hold.

Hash buckets that outgrow their size are divided by one more bit of the hash (``split_lake``): only their rows are
written again. Bucket b of modulus M becomes b and b + M of modulus 2M, so the directory is the list of divided
(level, bucket) pairs; it is kept in the log, or after a full reload in ``_layout``.

The commit of a dynamic overwrite replaces directories one by one: readers
running during the commit can see a mix of old and new buckets.
A plain path that is both read and statically overwritten would lose data, so
``overwrite_lake`` first materialises such input to the shared checkpoint
folder, and removes it after the commit.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tidemark.functions.lists import key_list
from tidemark.operators.keys import all_present, duplicate_keys
from tidemark.operators.sizing import DEFAULT_BROADCAST_ROWS, is_empty
from tidemark.operators.upsert import MergeAmbiguityError, align_to, delete_by_keys, matched_by_keys, merge_upsert, stage_swap
from tidemark.session import remove_dir, shared_dir
from tidemark.sinks.deltas import GONE, Commit, State, delta_path, next_seq, read_log, resolved, write_commit

BUCKET_COL = "_b"
LAYOUT_DIR = "_layout"
MIN_BUCKETS, MAX_BUCKETS = 64, 65_536
MAX_MODULUS = 1 << 30  #: bucket ids are ints
SPLIT_BITS = 6  #: more bits of the hash that one split may use
BUCKET_BYTES = 1 << 30


class LakeTableMissing(ValueError):
    """The lake table to be updated does not exist."""


class LayoutMismatch(ValueError):
    """The keys given are not those the table is laid out by."""


@dataclass(frozen=True)
class Layout:
    """How a keyed lake table assigns rows to buckets."""

    keys: tuple[str, ...]
    n_buckets: int | None
    range_width: int | None
    schema: str | None = field(default=None, compare=False)  # of the rows, as JSON: a delta needs no look at the base files
    splits: frozenset[tuple[int, int]] = frozenset()  # (level, bucket) pairs divided by one more bit of the hash

    def row_schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def bucket_type(self) -> T.DataType:
        return T.LongType() if self.range_width is not None else T.IntegerType()

    def file_schema(self) -> T.StructType:
        """Of the table's files, with the bucket."""
        return self.row_schema().add(BUCKET_COL, self.bucket_type())

    def bucket(self):
        return bucket_of(list(self.keys), self.n_buckets, self.range_width, self.splits)

    def level(self, bucket: int) -> int:
        """How many times the bucket's rows have been divided."""
        level = 0
        while (level, bucket % (self.n_buckets << level)) in self.splits:
            level += 1
        return level

    def divided(self, log: list[Commit]) -> Layout:
        """With the splits that the log holds."""
        return replace(self, splits=self.splits.union(*(c.splits for c in log)))


_LAYOUT_SCHEMA = "keys array<string>, n_buckets int, range_width long, schema string, splits array<array<bigint>>"


def write_layout(spark: SparkSession, path: str, layout: Layout, rows: DataFrame) -> None:
    """Store the layout of ``rows`` (without the bucket column)."""
    row = (list(layout.keys), layout.n_buckets, layout.range_width, rows.schema.json(), [list(x) for x in sorted(layout.splits)])
    spark.createDataFrame([row], _LAYOUT_SCHEMA).coalesce(1) \
        .write.mode("overwrite").json(f"{path.rstrip('/')}/{LAYOUT_DIR}")


def read_layout(spark: SparkSession, path: str, keys: list[str] | None = None, known: Layout | None = None) -> Layout:
    """The stored layout of a keyed table (``known``: as read before); ``keys`` (in any order and case) must be its keys."""
    layout = known or _read_layout(spark, path)
    if keys is not None and sorted(k.lower() for k in keys) != sorted(k.lower() for k in layout.keys):
        raise LayoutMismatch(f"{path} is laid out by {list(layout.keys)}, not by {keys}")
    return layout


def _read_layout(spark: SparkSession, path: str) -> Layout:
    try:
        row = spark.read.schema(_LAYOUT_SCHEMA).json(f"{path.rstrip('/')}/{LAYOUT_DIR}").first()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        row = None
    if row is None:
        raise LayoutMismatch(f"{path} has no stored layout: it is not a keyed lake table, or its full load did not finish")
    layout = Layout(tuple(row["keys"]), row["n_buckets"], row["range_width"], row["schema"],
                    frozenset((level, b) for level, b in row["splits"] or []))
    return layout if layout.n_buckets is None else layout.divided(read_log(spark, path))


def buckets_for(df: DataFrame) -> int:
    """Bucket count for a table, a bucket being about a gigabyte, from the planner's size estimate (no scan)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(MAX_BUCKETS, max(MIN_BUCKETS, -(-size // BUCKET_BYTES))) if size < 1 << 60 else 256


def load_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table's files, None where the path does not exist; any other fault is raised."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def bucket_of(keys: list[str], n_buckets: int, range_width: int | None = None, splits: Iterable[tuple[int, int]] = ()):
    cols = [F.col("`" + k.replace("`", "``") + "`") for k in keys]
    if range_width is not None:
        if len(keys) != 1 or range_width <= 0:
            raise ValueError("a key-range layout needs one integral key and a positive width")
        return F.coalesce(F.floor(cols[0] / F.lit(range_width)), F.lit(-1)).cast("bigint")
    bucket = F.pmod(F.xxhash64(*cols), F.lit(n_buckets))
    by_level: dict[int, list[int]] = {}
    for level, b in sorted(splits):
        by_level.setdefault(level, []).append(b)
    for level, divided in by_level.items():
        bucket = F.when(bucket.isin(divided), F.pmod(F.xxhash64(*cols), F.lit(n_buckets << (level + 1)))).otherwise(bucket)
    return bucket.cast("int")


def lake_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    return load_table(spark, path, fmt) is not None


def read_lake(spark: SparkSession, path: str, fmt: str = "parquet", *, broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """A lake table without its internal bucket column, its deltas resolved."""
    df = spark.read.format(fmt).load(path)
    if BUCKET_COL not in df.columns:
        return df
    log = read_log(spark, path)
    if log:
        df = current(spark, path, df, read_layout(spark, path), log, fmt, broadcast_rows)
    return df.drop(BUCKET_COL)


def current(spark: SparkSession, path: str, table: DataFrame, layout: Layout, log: list[Commit], fmt: str,
             broadcast_rows: int, buckets=None) -> DataFrame:
    return resolved(spark, path, table, list(layout.keys), BUCKET_COL, log, fmt=fmt, broadcast_rows=broadcast_rows, buckets=buckets)


def _path_only(uri: str) -> str:
    """``hdfs://nn:8020/a/b`` / ``file:/a/b`` / ``/a/b`` → ``/a/b`` (decoded, no trailing slash)."""
    from urllib.parse import unquote, urlparse

    parsed = urlparse(uri)
    return "/" + unquote(parsed.path if parsed.scheme else uri).strip("/")


def _reads_from(df: DataFrame, path: str) -> bool:
    """Whether ``df`` reads files under ``path``. Scheme and authority are ignored:
    a false positive only costs a staging copy, a false negative would lose data.
    Only the root paths of the plan's file relations are looked at, not their files."""
    p = _path_only(path)
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation" or "HadoopFsRelation" not in leaf.relation().getClass().getName():
            continue
        roots = leaf.relation().location().rootPaths()
        for k in range(roots.size()):
            root = _path_only(roots.apply(k).toString())
            if (root + "/").startswith(p + "/") or (p + "/").startswith(root + "/"):
                return True
    return False


def _write(df: DataFrame, path: str, fmt: str, partition_by: list[str], mode: str, dynamic: bool) -> None:
    # explicit either way: a session default of 'dynamic' must not turn a full
    # replace into a partial one (stale buckets would survive)
    w = df.write.format(fmt).mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def _existing_buckets(spark: SparkSession, path: str, fmt: str) -> set:
    """Bucket ids present in a keyed table (partition values only; no data column is read)."""
    return {r[BUCKET_COL] for r in spark.read.format(fmt).load(path).select(BUCKET_COL).distinct().collect()}


def _clear_buckets(spark: SparkSession, path: str, fmt: str, schema, buckets) -> None:
    """Replace each bucket folder by an empty file set (static overwrite of that sub-folder only)."""
    empty = spark.createDataFrame([], schema)
    for b in sorted(buckets):  # bounded by the number of buckets
        _write(empty, f"{path.rstrip('/')}/{BUCKET_COL}={b}", fmt, [], "overwrite", dynamic=False)


def overwrite_lake(spark: SparkSession, df: DataFrame, path: str, *, keys: str | Iterable[str] | None = None,
                   n_buckets: int | None = None, fmt: str = "parquet",
                   partition_by: Iterable[str] | None = None, range_width: int | None = None,
                   crash_safe: bool = False) -> None:
    """Replace the whole table (full load). With ``keys`` the table is bucketed for upserts.

    A static overwrite deletes the old files when its write begins: if that job
    fails, the table is empty until the load is re-run. ``crash_safe=True`` (keyed tables
    that already exist) writes the new rows to the shared checkpoint folder first, so that a failing source never
    touches the table. A table that keeps its layout then gets them with a dynamic partition
    overwrite (old buckets stay readable until that job commits), and buckets the new data no longer has are
    cleared; one with deltas gets them as a folder that its log switches to; one of another layout (or
    without keys before) is overwritten from the staged rows. It costs a second write. Without
    ``n_buckets`` a table keeps its stored bucket count and its splits.
    """
    parts = list(partition_by or [])
    ks = key_list(keys) if keys else []
    if not ks:
        staging = None
        if _reads_from(df, path):
            staging = shared_dir(spark, "overwrite-staging")
            df.write.format("parquet").mode("overwrite").save(staging)
            df = spark.read.parquet(staging)
        _write(df, path, fmt, parts, "overwrite", dynamic=False)
        if staging:
            remove_dir(spark, staging)
        return
    if parts:
        raise ValueError("a keyed lake table is partitioned by its buckets; partition_by goes with tables without keys")
    old = load_table(spark, path, fmt) if crash_safe or n_buckets is None and range_width is None else None
    stored = stored_layout(spark, path) if old is not None else None
    splits = frozenset()
    if range_width is None and n_buckets is None:
        # a table keeps its bucket count: a new estimate would differ from load to load
        keeps = stored is not None and stored.keys == tuple(ks) and stored.n_buckets is not None
        n_buckets = stored.n_buckets if keeps else buckets_for(df)
        splits = stored.splits if keeps else frozenset()
    layout = Layout(tuple(ks), None if range_width is not None else n_buckets, range_width, splits=splits)
    keyed = df.withColumn(BUCKET_COL, layout.bucket()).hint("rebalance", BUCKET_COL)
    staging = None
    if crash_safe and old is not None or _reads_from(df, path):
        staging = shared_dir(spark, "reload-staging")
        staged_schema = keyed.select(*[c for c in keyed.columns if c != BUCKET_COL], BUCKET_COL).schema
        _write(keyed, staging, "parquet", [BUCKET_COL], "overwrite", dynamic=False)
        keyed = spark.read.schema(staged_schema).parquet(staging)  # schema given: staging may be empty
    log = read_log(spark, path) if crash_safe and stored == layout else []
    if log and df.dtypes == old.drop(BUCKET_COL).dtypes:
        _commit_base(spark, path, keyed, log, fmt, buckets=None)  # the log switches to the new rows at once
    elif crash_safe and stored == layout and not log:
        before = _existing_buckets(spark, path, fmt)
        new = {r[BUCKET_COL] for r in keyed.select(BUCKET_COL).distinct().collect()}
        if new:
            _write(keyed, path, fmt, [BUCKET_COL], "overwrite", dynamic=True)
        _clear_buckets(spark, path, fmt, old.drop(BUCKET_COL).schema, before - new)
    else:  # a new table or another layout; deltas and their log go with the old files
        _write(keyed, path, fmt, [BUCKET_COL], "overwrite", dynamic=False)
        write_layout(spark, path, layout, df)
    if staging:
        remove_dir(spark, staging)


def stored_layout(spark: SparkSession, path: str) -> Layout | None:
    try:
        return read_layout(spark, path)
    except LayoutMismatch:
        return None


def _commit_base(spark: SparkSession, path: str, rows: DataFrame, log: list[Commit], fmt: str, buckets: list | None,
                 splits: tuple[tuple[int, int], ...] = ()) -> None:
    """Write ``rows`` (with their bucket) as the new base of ``buckets`` (None: of all) and switch the log to it."""
    seq = next_seq(log)
    _write(rows.hint("rebalance", BUCKET_COL), delta_path(path, seq), fmt, [BUCKET_COL], "overwrite", dynamic=False)
    commit = Commit(seq, "base", dict.fromkeys(buckets or [], 0), whole=buckets is None, splits=splits)
    write_commit(spark, path, commit)
    for unused in sorted(State.of(log).used() - State.of([*log, commit]).used()):  # readers that began before have to be done
        remove_dir(spark, delta_path(path, unused))


@dataclass(frozen=True)
class UpsertResult:
    source_rows: int
    touched_buckets: int
    rewritten_buckets: int
    created: bool


def _in_buckets(table: DataFrame, buckets: list) -> DataFrame:
    return table.where(F.col(BUCKET_COL).isin(buckets))


def _buckets_with(table: DataFrame, src: DataFrame, ks: list[str], touched: list, broadcast_rows: int, small: bool) -> list:
    """Which of the touched buckets hold a key of the slice (key columns only)."""
    held = _in_buckets(table, touched).select(*[F.col("`" + k.replace("`", "``") + "`") for k in ks], BUCKET_COL)
    hit = matched_by_keys(held, src, ks, broadcast_rows=broadcast_rows, small=small)
    return sorted(r[BUCKET_COL] for r in hit.select(BUCKET_COL).distinct().collect())


def _apply_by_bucket(spark: SparkSession, source: DataFrame, path: str, keys: str | Iterable[str], *,
                     mode: str, fmt: str, check_ambiguous: bool, broadcast_rows: int, create: bool,
                     n_buckets: int | None, range_width: int | None, as_delta: bool, tag: str | None,
                     refuse_null_keys: bool) -> UpsertResult:
    ks = key_list(keys)
    log = read_log(spark, path)
    if tag is not None and any(c.tag == tag for c in log):
        return UpsertResult(0, 0, 0, False)  # this slice was committed before
    as_delta = as_delta or bool(log)  # the base files alone are not the table then
    stored = stored_layout(spark, path) if as_delta else None
    target_all = None
    if stored is not None and stored.schema is not None:  # base files are not even listed
        layout = read_layout(spark, path, ks, stored)
        rows, kind = spark.createDataFrame([], layout.row_schema()), layout.bucket_type()
    else:
        target_all = load_table(spark, path, fmt)
        if target_all is None:
            if not create:
                raise LakeTableMissing(f"{path} does not exist: load the whole table first, or pass create=True")
            overwrite_lake(spark, source, path, keys=ks, n_buckets=n_buckets, fmt=fmt, range_width=range_width)
            return UpsertResult(-1, -1, -1, True)
        layout = read_layout(spark, path, ks)
        rows, kind = target_all.drop(BUCKET_COL), target_all.schema[BUCKET_COL].dataType
    ks = list(layout.keys)
    src = align_to(rows, source).withColumn(BUCKET_COL, layout.bucket().cast(kind))
    src = src.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # One job: rows, keyed rows and distinct keys per touched bucket (at most one
        # small row per bucket of the table reaches the driver). Keys are distinct
        # within the source iff distinct keys == keyed rows in every bucket, and only
        # then can the MERGE skip its duplicate-source-key probe.
        keyed = all_present(ks)
        per_bucket = src.groupBy(BUCKET_COL).agg(
            F.count(F.lit(1)).alias("n"), F.count(F.when(keyed, F.lit(1))).alias("n_keyed"),
            F.count_distinct(*[F.col("`" + k.replace("`", "``") + "`") for k in ks]).alias("n_distinct"),
        ).collect()
        n_src = sum(r["n"] for r in per_bucket)
        if n_src == 0:
            return UpsertResult(0, 0, 0, False)
        touched = sorted(r[BUCKET_COL] for r in per_bucket)
        source_has_dups = any(r["n_distinct"] < r["n_keyed"] for r in per_bucket)
        small = sum(r["n_keyed"] for r in per_bucket) <= broadcast_rows  # proven: keyed source rows
        if refuse_null_keys and not as_delta and any(r["n_keyed"] < r["n"] for r in per_bucket):
            raise ValueError(f"{path}: the slice has rows with NULL keys, which a second try would insert again")
        if as_delta:
            if mode == "merge" and check_ambiguous and source_has_dups:
                dups = duplicate_keys(src.where(keyed), ks)
                held = current(spark, path, spark.read.format(fmt).load(path), layout, log, fmt, broadcast_rows, touched)
                if not is_empty(matched_by_keys(held, dups, ks, broadcast_rows=broadcast_rows, small=small)):
                    raise MergeAmbiguityError(f"several source rows match the same target row on keys {ks}")
            seq = next_seq(log)
            _write(src.withColumn(GONE, F.lit(False)).hint("rebalance", BUCKET_COL), delta_path(path, seq), fmt, [BUCKET_COL],
                   "overwrite", dynamic=False)
            write_commit(spark, path, Commit(seq, "delta", {r[BUCKET_COL]: r["n"] for r in per_bucket}, tag=tag))
            return UpsertResult(n_src, len(touched), 0, False)
        rewrite = _buckets_with(target_all, src, ks, touched, broadcast_rows, small)
        if 4 * len(rewrite) >= 3 * len(touched):
            rewrite = touched  # appending to the few others would cost a second write and commit
        if rewrite:
            target = _in_buckets(target_all, rewrite).select(*src.columns)
            part = _in_buckets(src, rewrite)
            if mode == "merge":
                merged = merge_upsert(target, part, ks, check_ambiguous=check_ambiguous and source_has_dups,
                                      broadcast_rows=broadcast_rows, small=small)
            else:
                merged = stage_swap(target, part, ks, broadcast_rows=broadcast_rows, small=small)
            _write(merged.hint("rebalance", BUCKET_COL), path, fmt, [BUCKET_COL], "overwrite", dynamic=True)
        fresh = [b for b in touched if b not in set(rewrite)]
        if fresh:  # nothing to update there: the slice's rows are new files
            _write(_in_buckets(src, fresh).hint("rebalance", BUCKET_COL), path, fmt, [BUCKET_COL], "append", dynamic=False)
        return UpsertResult(n_src, len(touched), len(rewrite), False)
    finally:
        src.unpersist()


def upsert_lake(spark: SparkSession, source: DataFrame, path: str, keys: str | Iterable[str], *,
                create: bool = False, n_buckets: int | None = None, fmt: str = "parquet", check_ambiguous: bool = True,
                broadcast_rows: int = DEFAULT_BROADCAST_ROWS, range_width: int | None = None, as_delta: bool = False,
                tag: str | None = None, refuse_null_keys: bool = False) -> UpsertResult:
    """MERGE the source into the keyed lake table at ``path``, by its stored layout.

    ``n_buckets`` and ``range_width`` count only where ``create=True`` makes the table. ``as_delta`` writes the slice
    alone and leaves the merging to readers and ``compact_lake``; a table that has deltas takes deltas only.
    ``tag`` names the slice in the log: one that is there already is not applied again. ``refuse_null_keys`` fails
    where a second try of the slice would not leave the table as one did (NULL keys, no deltas)."""
    return _apply_by_bucket(spark, source, path, keys, mode="merge", fmt=fmt, check_ambiguous=check_ambiguous,
                            broadcast_rows=broadcast_rows, create=create, n_buckets=n_buckets, range_width=range_width,
                            as_delta=as_delta, tag=tag, refuse_null_keys=refuse_null_keys)


def swap_lake(spark: SparkSession, stage: DataFrame, path: str, keys: str | Iterable[str], *,
              create: bool = False, n_buckets: int | None = None, fmt: str = "parquet",
              broadcast_rows: int = DEFAULT_BROADCAST_ROWS, range_width: int | None = None, as_delta: bool = False,
              tag: str | None = None, refuse_null_keys: bool = False) -> UpsertResult:
    """Delete-by-key then insert the whole stage (duplicates kept), bucket by bucket; options as in ``upsert_lake``."""
    return _apply_by_bucket(spark, stage, path, keys, mode="swap", fmt=fmt, check_ambiguous=False,
                            broadcast_rows=broadcast_rows, create=create, n_buckets=n_buckets, range_width=range_width,
                            as_delta=as_delta, tag=tag, refuse_null_keys=refuse_null_keys)


def compact_lake(spark: SparkSession, path: str, *, most_buckets: int | None = None, least_rows: int = 1,
                 fmt: str = "parquet", broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> list[int]:
    """Merge the deltas of the worst buckets (most delta rows first, ``least_rows`` at least) into new bases.

    Returns the buckets. The others keep their files and deltas; the log switches to the new bases in one step."""
    log = read_log(spark, path)
    pending = {b: n for b, n in State.of(log).pending().items() if n >= least_rows}
    worst = sorted(pending, key=lambda b: (-pending[b], b))[:most_buckets]
    if worst:
        rows = current(spark, path, spark.read.format(fmt).load(path), read_layout(spark, path), log, fmt, broadcast_rows, worst)
        _commit_base(spark, path, rows, log, fmt, worst)
    return worst


def split_lake(spark: SparkSession, path: str, *, most_rows: int, fmt: str = "parquet",
               broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> list[int]:
    """Divide the hash buckets that hold more than ``most_rows`` rows until their parts don't, and return them.

    Only their rows are read in full and written, as new bases that the table's log switches to in one step, their deltas merged
    (so a table without deltas has a log from then on). Counting the others opens no column of theirs. At most ``SPLIT_BITS`` more bits of the hash are used at once; a
    bucket whose rows share all of them, as those of one hot key do, stays as it is.
    """
    log, layout = read_log(spark, path), read_layout(spark, path)
    if layout.n_buckets is None:
        raise ValueError(f"{path} is laid out by key ranges, which are not split")
    table = spark.read.format(fmt).load(path)
    rows = current(spark, path, table, layout, log, fmt, broadcast_rows)
    full = {r[BUCKET_COL]: r["count"] for r in rows.groupBy(BUCKET_COL).count().collect() if r["count"] > most_rows}
    if not full:
        return []
    rows = current(spark, path, table, layout, log, fmt, broadcast_rows, sorted(full))
    deep = layout.n_buckets << (max(layout.level(b) for b in full) + SPLIT_BITS)
    while deep > MAX_MODULUS:
        deep //= 2
    cells: dict[int, dict[int, int]] = {}  # 2^SPLIT_BITS a full bucket of the deepest level, and as many more a level above it
    counted = rows.groupBy(BUCKET_COL, bucket_of(list(layout.keys), deep).alias("cell")).count()
    for r in counted.collect():
        cells.setdefault(r[BUCKET_COL], {})[r["cell"]] = r["count"]
    splits: list[tuple[int, int]] = []
    parts: list[int] = []

    def divide(bucket: int, level: int, held: dict[int, int]) -> None:
        if sum(held.values()) <= most_rows or len(held) == 1:
            parts.append(bucket)
            return
        splits.append((level, bucket))
        for part in (bucket, bucket + (layout.n_buckets << level)):
            divide(part, level + 1, {c: n for c, n in held.items() if c % (layout.n_buckets << (level + 1)) == part})

    done = [b for b in sorted(cells) if len(cells[b]) > 1]
    for b in done:
        divide(b, layout.level(b), cells[b])
    if done:
        new = replace(layout, splits=layout.splits.union(splits))
        moved = _in_buckets(rows, done).withColumn(BUCKET_COL, new.bucket().cast(table.schema[BUCKET_COL].dataType))
        _commit_base(spark, path, moved, log, fmt, parts, tuple(splits))
    return done


@dataclass(frozen=True)
class DeleteResult:
    rewritten_buckets: int
    emptied_buckets: int


def delete_from_lake(spark: SparkSession, keys_df: DataFrame, path: str, keys: str | Iterable[str], *,
                     fmt: str = "parquet", broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DeleteResult:
    """DELETE the rows whose key is in ``keys_df`` from the keyed lake table at ``path``.

    A table with deltas gets the keys as one more (nothing is read or rewritten, no bucket counts as such). Else: the key columns of the buckets the keys hash to say which buckets hold a match
    and whether all their rows go. Only buckets with survivors are read in full and
    rewritten (dynamic partition overwrite); an emptied bucket's directory is replaced by an
    empty file set with a static overwrite of that one sub-folder.
    """
    target_all = load_table(spark, path, fmt)
    if target_all is None:
        raise LakeTableMissing(f"{path} does not exist")
    layout = read_layout(spark, path, key_list(keys))
    ks = list(layout.keys)
    data = target_all.drop(BUCKET_COL)
    quoted = [F.col("`" + k.replace("`", "``") + "`") for k in ks]
    kd = align_to(data.select(*quoted), keys_df.select(*quoted)).where(all_present(ks))
    kd = kd.withColumn(BUCKET_COL, layout.bucket().cast(target_all.schema[BUCKET_COL].dataType)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        key_buckets = kd.groupBy(BUCKET_COL).count().collect()  # at most one row per bucket
        if not key_buckets:
            return DeleteResult(0, 0)
        log = read_log(spark, path)
        if log:
            named = {k.lower() for k in ks}
            gone = kd.select(*[F.col(_quoted(f.name)) if f.name.lower() in named else F.lit(None).cast(f.dataType).alias(f.name) for f in data.schema.fields],
                             BUCKET_COL, F.lit(True).alias(GONE))
            _write(gone.hint("rebalance", BUCKET_COL), delta_path(path, next_seq(log)), fmt, [BUCKET_COL], "overwrite", dynamic=False)
            write_commit(spark, path, Commit(next_seq(log), "delta", {r[BUCKET_COL]: r["count"] for r in key_buckets}))
            return DeleteResult(0, 0)
        small = sum(r["count"] for r in key_buckets) <= broadcast_rows
        held = _in_buckets(target_all, sorted(r[BUCKET_COL] for r in key_buckets)).select(*quoted, BUCKET_COL)
        total = {r[BUCKET_COL]: r["count"] for r in held.groupBy(BUCKET_COL).count().collect()}
        gone = {r[BUCKET_COL]: r["count"] for r in matched_by_keys(held, kd, ks, broadcast_rows=broadcast_rows, small=small)
                .groupBy(BUCKET_COL).count().collect()}
        emptied = sorted(b for b, n in gone.items() if n == total[b])
        rewrite = sorted(set(gone) - set(emptied))
        if rewrite:
            survivors = delete_by_keys(_in_buckets(target_all, rewrite), kd, ks, broadcast_rows=broadcast_rows, small=small)
            _write(survivors.hint("rebalance", BUCKET_COL), path, fmt, [BUCKET_COL], "overwrite", dynamic=True)
        _clear_buckets(spark, path, fmt, data.schema, emptied)
        return DeleteResult(len(rewrite), len(emptied))
    finally:
        kd.unpersist()


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def merge_into_table(source: DataFrame, table: str, keys: str | Iterable[str]) -> None:
    """MERGE the source into a named catalog table, by the table format's own MERGE.

    For formats that have row-level operations (Spark refuses the others); the file layout
    above needs no such format."""
    ks = key_list(keys)
    on = F.expr(" AND ".join(f"_source.{_quoted(k)} = {table}.{_quoted(k)}" for k in ks))
    source.alias("_source").mergeInto(table, on).whenMatched().updateAll().whenNotMatched().insertAll().merge()
