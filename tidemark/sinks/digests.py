"""Full reloads that rewrite only the buckets that changed.

A file's digest is its row count and the sum and exclusive or of its rows' hashes: independent of their order, and a bucket's
digest is that of its files put together. Files never change, so ``_digests`` keeps one row a file and only
files it doesn't know are read. A reload digests the new rows by bucket (one aggregation, a row a bucket and task),
compares, and writes the buckets that differ with a dynamic partition overwrite; the other files stay as they are.
Two 64-bit hashes of different seeds make up a row's hash: an unnoticed change would need both sums, both
exclusive ors and the count to agree.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.functions.lists import key_list
from tidemark.operators.upsert import align_to
from tidemark.session import remove_dir, shared_dir
from tidemark.sinks.deltas import read_log
from tidemark.sinks.lake import BUCKET_COL, _clear_buckets, _reads_from, _write, load_table, overwrite_lake, stored_layout
from tidemark.sinks.zones import _leaf, data_files

DIGESTS_DIR = "_digests"
_PARTS = ("n", "s1", "s2", "x1", "x2")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def digest_columns(columns: list[str]) -> list[Column]:
    """Aggregates of a set of rows: count, sums and exclusive ors of two hashes of each."""
    first = F.xxhash64(*[F.col(_q(c)) for c in columns])
    # a NULL leaves a hash as it was: which columns are NULL is hashed too
    second = F.xxhash64(F.lit(17), *[F.col(_q(c)) for c in columns], *[F.col(_q(c)).isNull() for c in columns])
    wide = lambda h: F.sum(h.cast("decimal(20,0)")).cast("string")
    return [F.count(F.lit(1)).alias("n"), wide(first).alias("s1"), wide(second).alias("s2"), F.bit_xor(first).alias("x1"), F.bit_xor(second).alias("x2")]


def refresh_digests(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``(file, n, s1, s2, x1, x2)`` of the table's present files; reads those that have no digest yet."""
    table = spark.read.format(fmt).load(path)
    files, where = data_files(table, path), f"{path.rstrip('/')}/{DIGESTS_DIR}"
    schema = "file string, n long, s1 string, s2 string, x1 long, x2 long"
    try:
        known = spark.read.schema(schema).parquet(where)
        names = {r["file"] for r in known.select("file").distinct().collect()}  # names only
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        names = set()
    new = [full for name, full in files.items() if name not in names]
    if new:
        rows = spark.read.format(fmt).schema(table.schema).option("basePath", path).load(new)
        name = F.substring_index(F.col("_metadata.file_path"), _leaf(path), -1).alias("file")
        data = [c for c in table.columns if c != BUCKET_COL]
        rows.groupBy(name).agg(*digest_columns(data)).coalesce(1).write.mode("append").parquet(where)
    here = spark.createDataFrame([(f,) for f in files], "file string")
    return spark.read.schema(schema).parquet(where).dropDuplicates(["file"]).join(here, "file", "left_semi") if files else here.join(
        spark.createDataFrame([], schema), "file")


def bucket_digests(files: DataFrame) -> dict[int, tuple]:
    """Digest of each bucket from those of its files."""
    bucket = F.regexp_extract("file", rf"{BUCKET_COL}=(-?\d+)/", 1).cast("bigint")
    wide = lambda c: F.sum(F.col(c).cast("decimal(30,0)")).cast("string").alias(c)
    rows = files.groupBy(bucket.alias("b")).agg(F.sum("n").alias("n"), wide("s1"), wide("s2"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    return {r["b"]: tuple(r[p] for p in _PARTS) for r in rows.collect() if r["n"]}  # one row a bucket


@dataclass(frozen=True)
class ReloadResult:
    rewritten_buckets: int
    cleared_buckets: int
    kept_buckets: int


def reload_lake(spark: SparkSession, df: DataFrame, path: str, keys: str | Iterable[str], *, n_buckets: int | None = None,
                fmt: str = "parquet") -> ReloadResult:
    """Full load that leaves buckets alone whose rows are the same.

    The source is read twice, for its digests and for the rows that changed. A table that isn't there, has
    deltas, other keys or other columns is replaced whole (its buckets all count as rewritten)."""
    ks = key_list(keys)
    table, stored = load_table(spark, path, fmt), stored_layout(spark, path)
    same = table is not None and stored is not None and stored.keys == tuple(ks) and n_buckets in (None, stored.n_buckets) \
        and sorted(df.dtypes) == sorted(table.drop(BUCKET_COL).dtypes) and not read_log(spark, path)
    if not same:
        overwrite_lake(spark, df, path, keys=ks, n_buckets=n_buckets, fmt=fmt)
        return ReloadResult(len(bucket_digests(refresh_digests(spark, path, fmt))), 0, 0)
    data = table.drop(BUCKET_COL)
    rows = align_to(data, df)
    staging = None
    if _reads_from(df, path):  # never read what is being overwritten
        staging = shared_dir(spark, "reload-staging")
        rows.write.parquet(staging)
        rows = spark.read.schema(rows.schema).parquet(staging)
    keyed = rows.withColumn(BUCKET_COL, stored.bucket().cast(table.schema[BUCKET_COL].dataType))
    new = {r[BUCKET_COL]: tuple(r[p] for p in _PARTS) for r in keyed.groupBy(BUCKET_COL).agg(*digest_columns(data.columns)).collect()}  # a row a bucket
    old = bucket_digests(refresh_digests(spark, path, fmt))
    changed, gone = sorted(b for b in new if new[b] != old.get(b)), sorted(set(old) - set(new))
    if changed:
        _write(keyed.where(F.col(BUCKET_COL).isin(changed)).hint("rebalance", BUCKET_COL), path, fmt, [BUCKET_COL], "overwrite", dynamic=True)
    _clear_buckets(spark, path, fmt, data.schema, gone)
    if staging:
        remove_dir(spark, staging)
    return ReloadResult(len(changed), len(gone), len(new) - len(changed))
