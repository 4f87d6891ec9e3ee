"""Reloads by digests; merges counted while they are written."""
import random

from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators.upsert import merge_metrics, merge_observed
from tidemark.sinks.digests import ReloadResult, reload_lake
from tidemark.sinks.lake import overwrite_lake, read_lake, upsert_lake
from test_lake import files_by_bucket

SCHEMA = "k bigint, v string, w double"


def test_only_changed_buckets_are_rewritten(spark, tmp_dir):
    path = tmp_dir + "/t"
    data = [(i, f"v{i % 7}", float(i)) for i in range(60)] + [(None, "n", None), (3, "v3", 3.0)]  # also NULLs and a repeated row
    frame = lambda d: spark.createDataFrame(d, SCHEMA).repartition(3)
    overwrite_lake(spark, frame(data), path, keys="k", range_width=10)
    before = files_by_bucket(path)
    random.Random(1).shuffle(data)
    assert reload_lake(spark, frame(data).select("w", "k", "v"), path, "k") == ReloadResult(0, 0, 7)  # order of rows and columns is nothing
    assert files_by_bucket(path) == before
    changed = [(k, "new" if k == 25 else v, w) for k, v, w in data if k is None or not 40 <= k < 50] + [(25, "v4", None)]
    assert reload_lake(spark, frame(changed), path, "k") == ReloadResult(1, 1, 5)
    after = files_by_bucket(path)
    assert {b for b in before if before[b] != after[b]} == {"_b=2", "_b=4"}
    assert rows(read_lake(spark, path)) == rows(frame(changed))
    upsert_lake(spark, frame([(7, "up", 1.0)]), path, "k")  # another writer: its files have no digest yet
    assert reload_lake(spark, frame(changed), path, "k") == ReloadResult(1, 0, 5)
    assert rows(read_lake(spark, path)) == rows(frame(changed))
    moved = [(k, None, w) if k == 11 else (k, v, w) for k, v, w in changed]  # a value becomes NULL
    assert reload_lake(spark, read_lake(spark, path).withColumn("v", F.expr("IF(k = 11, NULL, v)")), path, "k").rewritten_buckets == 1
    assert rows(read_lake(spark, path)) == rows(frame(moved))


def test_other_tables_are_replaced_whole(spark, tmp_dir):
    path = tmp_dir + "/t"
    one = spark.createDataFrame([(1, "a", 1.0)], SCHEMA)
    assert reload_lake(spark, one, path, "k", n_buckets=4).rewritten_buckets == 1  # not there
    upsert_lake(spark, spark.createDataFrame([(2, "b", 2.0)], SCHEMA), path, "k", as_delta=True)
    assert reload_lake(spark, one, path, "k").rewritten_buckets == 1 and rows(read_lake(spark, path)) == [(1, "a", 1.0)]
    wider = one.withColumn("x", F.lit(1))
    assert reload_lake(spark, wider, path, "k").kept_buckets == 0 and rows(read_lake(spark, path)) == [(1, "a", 1.0, 1)]


def test_counts_while_writing(spark, tmp_dir):
    target = spark.range(100).selectExpr("id AS k", "'old' AS v").unionByName(spark.createDataFrame([(None, "n")], "k bigint, v string"))
    for name, source in {"some": [(5, "x"), (6, "y"), (200, "z"), (None, "m")], "none": []}.items():
        src, path = spark.createDataFrame(source, "k bigint, v string"), f"{tmp_dir}/{name}"
        for bound in (1000, 0):
            counts = merge_observed(target, src, "k", lambda m: m.write.mode("overwrite").parquet(path), broadcast_rows=bound)  # noqa: B023
            want = merge_metrics(target, src, "k").first().asDict()
            assert counts == want
        assert spark.read.parquet(path).count() == want["rows_after"]
