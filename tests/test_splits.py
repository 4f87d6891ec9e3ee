"""Buckets of a lake table that are divided by further bits of the hash."""
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.sinks.deltas import read_log
from tidemark.sinks.lake import (BUCKET_COL, Layout, bucket_of, compact_lake, delete_from_lake, overwrite_lake, read_lake, read_layout,
                                 split_lake, swap_lake, upsert_lake)
from tidemark.sinks import deltas
from test_lake import files_by_bucket

SCHEMA = "k bigint, v string"


def table_of(spark, n, value="old"):
    return spark.range(n).select(F.col("id").alias("k"), F.lit(value).alias("v"))


def by_bucket(spark, path, n):
    """Rows per bucket as the layout addresses them, and as the files hold them."""
    layout = read_layout(spark, path)
    addressed = read_lake(spark, path).groupBy(layout.bucket().alias("b")).count()
    state = deltas.State.of(read_log(spark, path))
    held = {}
    for b in {r["b"] for r in addressed.collect()}:
        seq = state.base_of(b)
        where = f"{path}/_deltas/_seq={seq}/{BUCKET_COL}={b}" if seq else f"{path}/{BUCKET_COL}={b}"
        held[b] = spark.read.schema(SCHEMA).parquet(where).count()
    return {r["b"]: r["count"] for r in addressed.collect()}, held


def test_only_full_buckets_are_written_again(spark, tmp_dir):
    path = tmp_dir + "/t"
    few = table_of(spark, 4000).withColumn("b", bucket_of(["k"], 4)).where("b <> 2 or k % 10 = 0").drop("b")
    overwrite_lake(spark, few, path, keys="k", n_buckets=4)
    want, before = rows(read_lake(spark, path)), files_by_bucket(path)
    assert split_lake(spark, path, most_rows=5000) == [] and read_log(spark, path) == []
    assert split_lake(spark, path, most_rows=600) == [0, 1, 3]
    assert rows(read_lake(spark, path)) == want and files_by_bucket(path) == before  # the log has switched, no file is gone
    layout = read_layout(spark, path)
    assert layout.splits == {(0, 0), (0, 1), (0, 3)} and {layout.level(b) for b in (0, 4, 1, 5, 3, 7)} == {1} and layout.level(2) == 0
    addressed, held = by_bucket(spark, path, 4)
    assert addressed == held and set(held) == {0, 1, 2, 3, 4, 5, 7} and max(held.values()) <= 600
    assert split_lake(spark, path, most_rows=600) == []
    assert set(split_lake(spark, path, most_rows=150)) == {0, 1, 3, 4, 5, 7}  # several levels in one commit
    addressed, held = by_bucket(spark, path, 4)
    assert addressed == held and max(held.values()) <= 150 and rows(read_lake(spark, path)) == want


def test_slices_go_to_the_parts(spark, tmp_dir):
    path = tmp_dir + "/t"
    overwrite_lake(spark, table_of(spark, 1000), path, keys="k", n_buckets=2)
    split_lake(spark, path, most_rows=200)
    new = spark.createDataFrame([(i, "new") for i in range(0, 1100, 7)], SCHEMA)
    res = upsert_lake(spark, new, path, "k")
    assert res.touched_buckets > 2 and res.rewritten_buckets == 0
    got = dict(rows(read_lake(spark, path)))
    assert len(got) == 1000 + sum(i >= 1000 for i in range(0, 1100, 7)) and all((v == "new") == (k % 7 == 0) for k, v in got.items())
    compact_lake(spark, path)
    assert dict(rows(read_lake(spark, path))) == got
    overwrite_lake(spark, read_lake(spark, path), path, keys="k")  # folded: the reload keeps the parts
    assert read_log(spark, path) == [] and dict(rows(read_lake(spark, path))) == got
    assert len(read_layout(spark, path).splits) >= 2
    addressed, held = by_bucket(spark, path, 2)
    assert addressed == held and len(held) > 2
    assert upsert_lake(spark, new.withColumn("v", F.lit("newer")), path, "k").rewritten_buckets > 2
    assert sum(v == "newer" for _, v in rows(read_lake(spark, path))) == new.count()


@pytest.mark.parametrize("seed", [1, 2])
def test_random_order_of_work(spark, tmp_dir, seed):
    rng, path = random.Random(seed), tmp_dir + "/t"
    held = {i: "0" for i in range(300)}
    overwrite_lake(spark, spark.createDataFrame(list(held.items()), SCHEMA), path, keys="k", n_buckets=2)
    for step, kind in enumerate(rng.choices(["upsert", "swap", "delete", "split", "compact"], [3, 2, 2, 4, 1], k=9)):
        keys = rng.sample(range(400), 30)
        if kind == "split":
            split_lake(spark, path, most_rows=rng.choice([10, 30, 60]))
        elif kind == "compact":
            compact_lake(spark, path, most_buckets=rng.choice([1, 5]))
        elif kind == "delete":
            delete_from_lake(spark, spark.createDataFrame([(k,) for k in keys], "k bigint"), path, "k")
            held = {k: v for k, v in held.items() if k not in keys}
        else:
            slice_ = spark.createDataFrame([(k, str(step)) for k in keys], SCHEMA)
            (upsert_lake if kind == "upsert" else swap_lake)(spark, slice_, path, "k")
            held |= {k: str(step) for k in keys}
        assert dict(rows(read_lake(spark, path))) == held, (step, kind)


def test_a_hot_key_and_null_keys_stay_together(spark, tmp_dir):
    path = tmp_dir + "/t"
    data = [(7, f"v{i}") for i in range(500)] + [(None, "n")] * 300 + [(i, "x") for i in range(1000, 1100)]
    overwrite_lake(spark, spark.createDataFrame(data, SCHEMA), path, keys="k", n_buckets=1)
    want = rows(read_lake(spark, path))
    for _ in range(3):
        split_lake(spark, path, most_rows=50)
    assert rows(read_lake(spark, path)) == want
    assert split_lake(spark, path, most_rows=50) == []  # what is left above the bound can't be divided
    assert max(level for level, _ in read_layout(spark, path).splits) < 20


def test_a_split_that_was_lost_is_not_seen(spark, tmp_dir, monkeypatch):
    path = tmp_dir + "/t"
    overwrite_lake(spark, table_of(spark, 500), path, keys="k", n_buckets=2)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr("tidemark.sinks.lake.write_commit", lost)
        with pytest.raises(RuntimeError):
            split_lake(spark, path, most_rows=100)
    assert read_layout(spark, path).splits == frozenset() and read_lake(spark, path).count() == 500
    upsert_lake(spark, table_of(spark, 600, "new"), path, "k")
    assert split_lake(spark, path, most_rows=100) == [0, 1]
    assert {v for _, v in rows(read_lake(spark, path))} == {"new"} and read_lake(spark, path).count() == 600


def test_other_layouts(spark, tmp_dir):
    path = tmp_dir + "/t"
    overwrite_lake(spark, table_of(spark, 100), path, keys="k", range_width=10)
    with pytest.raises(ValueError, match="ranges"):
        split_lake(spark, path, most_rows=5)
    layout = Layout(("k",), 4, None, splits=frozenset({(0, 1), (1, 5)}))
    assert [layout.level(b) for b in (0, 1, 5, 13, 2)] == [0, 1, 2, 2, 0]
    got = {r["b"] for r in spark.range(2000).select(F.col("id").alias("k")).select(layout.bucket().alias("b")).distinct().collect()}
    assert got == {0, 1, 2, 3, 5, 13}
