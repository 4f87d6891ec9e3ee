import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import MergeAmbiguityError
from tidemark.sinks.lake import BUCKET_COL, overwrite_lake, read_lake, swap_lake, upsert_lake

SCHEMA = "k bigint, v string"


def files_by_bucket(path):
    out = {}
    for d in glob.glob(f"{path}/{BUCKET_COL}=*"):
        out[os.path.basename(d)] = sorted((f, os.path.getmtime(f)) for f in glob.glob(d + "/*.parquet"))
    return out


def test_upsert_creates_then_touches_only_its_buckets(spark, tmp_dir):
    path = tmp_dir + "/t"
    base = spark.range(0, 400).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    upsert_lake(spark, base, path, "k", n_buckets=16, create=True)
    assert read_lake(spark, path).count() == 400
    before = files_by_bucket(path)
    src = spark.createDataFrame([(3, "new"), (1000, "ins")], SCHEMA)
    res = upsert_lake(spark, src, path, "k", n_buckets=16)
    assert res.source_rows == 2 and 1 <= res.touched_buckets <= 2
    after = files_by_bucket(path)
    changed = [b for b in before if before[b] != after.get(b)]
    assert 1 <= len(changed) <= 2  # the other buckets' files were not rewritten
    got = {r.k: r.v for r in read_lake(spark, path).collect()}
    assert len(got) == 401 and got[3] == "new" and got[1000] == "ins" and got[4] == "old"
    assert BUCKET_COL not in read_lake(spark, path).columns


def test_upsert_idempotent_and_ambiguity(spark, tmp_dir):
    path = tmp_dir + "/t"
    overwrite_lake(spark, spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), path, keys="k", n_buckets=8)
    src = spark.createDataFrame([(2, "B"), (3, "C")], SCHEMA)
    upsert_lake(spark, src, path, "k", n_buckets=8)
    first = rows(read_lake(spark, path))
    upsert_lake(spark, src, path, "k", n_buckets=8)
    assert rows(read_lake(spark, path)) == first == [(1, "a"), (2, "B"), (3, "C")]
    with pytest.raises(MergeAmbiguityError):
        upsert_lake(spark, spark.createDataFrame([(1, "x"), (1, "y")], SCHEMA), path, "k", n_buckets=8)
    assert rows(read_lake(spark, path)) == first  # a failed merge leaves the table as it was


def test_swap_keeps_stage_duplicates_and_empty_source_is_noop(spark, tmp_dir):
    path = tmp_dir + "/t"
    overwrite_lake(spark, spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), path, keys="k", n_buckets=8)
    swap_lake(spark, spark.createDataFrame([(1, "x"), (1, "y")], SCHEMA), path, "k", n_buckets=8)
    assert rows(read_lake(spark, path)) == [(1, "x"), (1, "y"), (2, "b")]
    res = upsert_lake(spark, spark.createDataFrame([], SCHEMA), path, "k", n_buckets=8)
    assert res.source_rows == 0 and read_lake(spark, path).count() == 3


def test_overwrite_from_the_same_path_is_safe(spark, tmp_dir):
    path = tmp_dir + "/t"
    overwrite_lake(spark, spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), path, keys="k", n_buckets=4)
    cur = read_lake(spark, path).filter(F.col("k") == 1)
    overwrite_lake(spark, cur, path, keys="k", n_buckets=4)
    assert rows(read_lake(spark, path)) == [(1, "a")]


def test_source_with_hot_key_is_written_whole(spark, tmp_dir):
    # a third of the rows share one key (swap keeps them all)
    path = tmp_dir + "/t"
    overwrite_lake(spark, spark.createDataFrame([(0, "seed")], SCHEMA), path, keys="k", n_buckets=8)
    hot = spark.range(0, 900).select(F.when(F.col("id") % 3 == 0, F.lit(-7)).otherwise(F.col("id")).alias("k"),
                                     F.col("id").cast("string").alias("v"))
    swap_lake(spark, hot, path, "k", n_buckets=8)
    out = read_lake(spark, path)
    assert out.count() == 901 and out.filter("k = -7").count() == 300


def test_key_range_layout_touches_only_recent_ranges(spark, tmp_dir):
    path = tmp_dir + "/t"
    base = spark.range(0, 1000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    overwrite_lake(spark, base, path, keys="k", range_width=100)
    before = files_by_bucket(path)
    assert len(before) == 10
    src = spark.createDataFrame([(995, "upd"), (1001, "ins"), (1050, "ins"), (None, "nullkey")], SCHEMA)
    res = upsert_lake(spark, src, path, "k", range_width=100)
    assert res.touched_buckets == 3  # ranges 9 and 10, and the NULL-key bucket
    after = files_by_bucket(path)
    assert [b for b in before if before[b] != after.get(b)] == [f"{BUCKET_COL}=9"]
    got = {r.k: r.v for r in read_lake(spark, path).collect()}
    assert len(got) == 1003 and got[995] == "upd" and got[1050] == "ins" and got[None] == "nullkey"
    again = spark.createDataFrame([(None, "second")], SCHEMA)
    upsert_lake(spark, again, path, "k", range_width=100)
    assert read_lake(spark, path).filter("k IS NULL").count() == 2  # NULL keys never match


def test_full_replace_ignores_a_dynamic_session_default(spark, tmp_dir):
    path = tmp_dir + "/t"
    overwrite_lake(spark, spark.createDataFrame([(i, "old") for i in range(50)], SCHEMA), path, keys="k", n_buckets=8)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        overwrite_lake(spark, spark.createDataFrame([(1, "new")], SCHEMA), path, keys="k", n_buckets=8)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows(read_lake(spark, path)) == [(1, "new")]


def test_delete_from_lake_clears_emptied_buckets(spark, tmp_dir):
    from tidemark.sinks.lake import delete_from_lake

    path = tmp_dir + "/t"
    overwrite_lake(spark, spark.createDataFrame([(i, "v") for i in range(40)], SCHEMA), path, keys="k",
                   range_width=10)
    before = files_by_bucket(path)
    # all of range 1 (10..19), part of range 2, a key that does not exist, and a NULL
    keys = spark.createDataFrame([(k,) for k in list(range(10, 20)) + [25, 26, 999]] + [(None,)], "k int")
    res = delete_from_lake(spark, keys, path, "K")
    assert (res.rewritten_buckets, res.emptied_buckets) == (1, 1)  # range 2 is rewritten, range 1 emptied
    got = sorted(r.k for r in read_lake(spark, path).collect())
    assert got == [k for k in range(40) if not (10 <= k < 20 or k in (25, 26))]
    after = files_by_bucket(path)
    assert f"{BUCKET_COL}=99" not in after  # no folder for a bucket that held nothing
    assert before[f"{BUCKET_COL}=0"] == after[f"{BUCKET_COL}=0"] and before[f"{BUCKET_COL}=3"] == after[f"{BUCKET_COL}=3"]


def test_path_comparison_ignores_scheme_and_authority():
    from tidemark.sinks.lake import _path_only

    assert _path_only("hdfs://nn:8020/lake/t/") == _path_only("/lake/t") == _path_only("file:/lake/t") == "/lake/t"
    assert _path_only("s3a://bucket/lake/a%3Db") == "/lake/a=b"


def test_crash_safe_reload_keeps_old_rows_when_the_load_fails(spark, tmp_dir):
    path = tmp_dir + "/t"
    old = spark.createDataFrame([(i, "old") for i in range(30)], SCHEMA)
    overwrite_lake(spark, old, path, keys="k", n_buckets=8)
    failing = spark.createDataFrame([(i, "new") for i in range(30)], SCHEMA).withColumn(
        "v", F.when(F.col("k") == 17, F.raise_error(F.lit("source failed mid-load"))).otherwise(F.col("v")))
    with pytest.raises(Exception):
        overwrite_lake(spark, failing, path, keys="k", n_buckets=8, crash_safe=True)
    assert read_lake(spark, path).count() == 30  # the old table is intact
    # a successful safe reload replaces everything, including buckets the new data no longer has
    overwrite_lake(spark, spark.createDataFrame([(1, "new"), (2, "new")], SCHEMA), path, keys="k", n_buckets=8,
                   crash_safe=True)
    assert rows(read_lake(spark, path)) == [(1, "new"), (2, "new")]
    overwrite_lake(spark, spark.createDataFrame([], SCHEMA), path, keys="k", n_buckets=8, crash_safe=True)
    assert read_lake(spark, path).count() == 0


def test_stored_layout_wins_over_arguments(spark, tmp_dir):
    """A table of 64 buckets upserted and deleted from with other counts and key orders."""
    from tidemark.sinks.lake import delete_from_lake

    path = tmp_dir + "/t"
    two = "id bigint, k2 string, v string"
    base = spark.createDataFrame([(i, str(i % 3), "old") for i in range(100)], two)
    overwrite_lake(spark, base, path, keys="id|k2", n_buckets=64)
    upsert_lake(spark, spark.createDataFrame([(i, str(i % 3), "new") for i in range(50, 130)], two), path, "K2|ID", n_buckets=256)
    got = {r.id: r.v for r in read_lake(spark, path).collect()}
    assert len(got) == read_lake(spark, path).count() == 130 and got[49] == "old" and got[50] == "new"
    delete_from_lake(spark, base.select("k2", "id"), path, "k2|id")
    assert sorted(r.id for r in read_lake(spark, path).collect()) == list(range(100, 130))


def test_other_keys_are_refused(spark, tmp_dir):
    from tidemark.sinks.lake import LayoutMismatch, delete_from_lake

    path, plain = tmp_dir + "/t", tmp_dir + "/plain"
    df = spark.createDataFrame([(1, "a")], SCHEMA)
    overwrite_lake(spark, df, path, keys="k", n_buckets=4)
    overwrite_lake(spark, df, plain)
    for call in (lambda: upsert_lake(spark, df, path, "v"), lambda: swap_lake(spark, df, path, "k|v"),
                 lambda: delete_from_lake(spark, df, path, "v"), lambda: upsert_lake(spark, df, plain, "k")):
        with pytest.raises(LayoutMismatch):
            call()
    with pytest.raises(ValueError):
        overwrite_lake(spark, df, path, keys="k", partition_by=["v"])


def test_a_slice_never_makes_a_table_by_itself(spark, tmp_dir):
    from tidemark.sinks.lake import LakeTableMissing, delete_from_lake

    df = spark.createDataFrame([(1, "a")], SCHEMA)
    for call in (upsert_lake, swap_lake, delete_from_lake):
        with pytest.raises(LakeTableMissing):
            call(spark, df, tmp_dir + "/none", "k")
    assert not os.path.exists(tmp_dir + "/none")


def test_inserts_are_appended_and_only_buckets_with_matches_rewritten(spark, tmp_dir):
    path = tmp_dir + "/t"
    overwrite_lake(spark, spark.range(0, 3000).select(F.col("id").alias("k"), F.lit("old").alias("v")), path, keys="k", n_buckets=64)
    before = {f for fs in files_by_bucket(path).values() for f in fs}
    inserts = spark.range(5000, 5209).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    res = upsert_lake(spark, inserts, path, "k")
    assert res.touched_buckets > 50 and res.rewritten_buckets == 0
    assert before <= {f for fs in files_by_bucket(path).values() for f in fs}  # no file was replaced
    mixed = inserts.limit(200).unionByName(spark.createDataFrame([(7, "upd"), (8, "upd")], SCHEMA)).withColumn("k", F.col("k") + F.when(F.col("v") == "new", 10_000).otherwise(0))
    before = {f for fs in files_by_bucket(path).values() for f in fs}
    res = upsert_lake(spark, mixed, path, "k")
    assert res.rewritten_buckets <= 2
    gone = before - {f for fs in files_by_bucket(path).values() for f in fs}
    assert len({os.path.dirname(f) for f, _ in gone}) <= 2
    got = {r.k: r.v for r in read_lake(spark, path).collect()}
    assert len(got) == 3000 + 209 + 200 and got[7] == "upd" and got[9] == "old"


def test_staging_is_removed_after_the_commit(spark, tmp_dir):
    base = spark.conf.get("spark.checkpoint.dir") + "/tidemark"
    staged = lambda: set(glob.glob(base + "/*staging*"))
    before = staged()
    path = tmp_dir + "/t"
    overwrite_lake(spark, spark.createDataFrame([(1, "a")], SCHEMA), path, keys="k", n_buckets=4)
    overwrite_lake(spark, read_lake(spark, path), path, keys="k", n_buckets=4)
    overwrite_lake(spark, spark.createDataFrame([(2, "b")], SCHEMA), path, keys="k", n_buckets=4, crash_safe=True)
    assert rows(read_lake(spark, path)) == [(2, "b")] and staged() == before


def test_bucket_count_follows_the_size(spark, tmp_dir):
    from tidemark.sinks.lake import MIN_BUCKETS, read_layout

    path = tmp_dir + "/t"
    spark.createDataFrame([(1, "a")], SCHEMA).write.parquet(tmp_dir + "/src")
    overwrite_lake(spark, spark.read.parquet(tmp_dir + "/src"), path, keys="k")
    assert read_layout(spark, path).n_buckets == MIN_BUCKETS
