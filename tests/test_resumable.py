"""Counted key ranges and loads that go on where they stopped."""
import datetime as dt
import decimal
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import selection
from tidemark.operators.selection import counted_ranges
from tidemark.plans.resumable import PlanMismatch, resumable_load
from tidemark.sinks.lake import overwrite_lake, read_lake


def test_ranges_are_disjoint_cover_and_hold_what_they_say(spark, monkeypatch):
    monkeypatch.setattr(selection, "BINS", 8)
    big = 1 << 62
    for kind, keys in {"bigint": [*range(300), *[big + i for i in range(40)], *[7] * 60, -big, None, None],
                       "decimal(30,3)": [decimal.Decimal(i) / 8 for i in range(200)],
                       "timestamp_ntz": [dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i * i) for i in range(200)],
                       "string": [f"order#{i:06d}" for i in range(200)] + [None]}.items():
        df = spark.createDataFrame([(k,) for k in keys], f"k {kind}").cache()
        got = counted_ranges(df, "k", 30)
        present = sorted(k for k in keys if k is not None)
        nulls = keys.count(None)
        assert (got[0] == (None, None, nulls)) == bool(nulls)
        parts = got[1:] if nulls else got
        assert sum(n for *_, n in parts) == len(present)
        assert all(a[1] < b[0] for a, b in zip(parts, parts[1:], strict=False))
        assert all(n == sum(lo <= k <= hi for k in present) and (n <= 30 or lo == hi) for lo, hi, n in parts)
        assert len(parts) <= 2 * len(present) / 30 + 4
        df.unpersist()
    assert counted_ranges(spark.createDataFrame([], "k int"), "k", 5) == []
    with pytest.raises(ValueError):
        counted_ranges(spark.createDataFrame([(1.5,)], "k double"), "k", 5)


def test_a_rerun_loads_only_what_is_missing(spark, tmp_dir):
    source = spark.range(100).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v")).unionByName(
        spark.createDataFrame([(None, "n")], "k bigint, v string"))
    path, staging, seen = tmp_dir + "/t", tmp_dir + "/staging", []
    overwrite_lake(spark, spark.createDataFrame([(-1, "old")], "k bigint, v string"), path, keys="k", n_buckets=4)

    def failing(i, df):
        if i == 2:
            raise ConnectionError("lost")
        seen.append(i)
        return df

    load = lambda f, **o: resumable_load(spark, source, path, "k", staging, keys="k", rows_per_range=30, on_range=f, **o)
    with pytest.raises(ConnectionError):
        load(failing)
    assert seen == [0, 1] and rows(read_lake(spark, path)) == [(-1, "old")]  # the target is as it was
    with pytest.raises(PlanMismatch):
        resumable_load(spark, source.withColumn("more", F.lit(1)), path, "k", staging, keys="k")
    seen.clear()
    assert load(lambda i, df: seen.append(i) or df.withColumn("v", F.upper("v")), parallelism=2) == 3
    assert sorted(seen) == [-1, 2, 3, 4]  # -1: for the schema
    got = dict(rows(read_lake(spark, path)))
    assert len(got) == 101 and got[None] == "n" and sum(v[0] == "V" for v in got.values()) == 100 - 30  # the null range and one of 30 were staged before
    assert not os.path.exists(staging)
    assert load(None) == 5 and len(rows(read_lake(spark, path))) == 101  # a new load


def test_an_empty_table(spark, tmp_dir):
    empty = spark.createDataFrame([], "k bigint, v string")
    assert resumable_load(spark, empty, tmp_dir + "/t", "k", tmp_dir + "/s") == 0
