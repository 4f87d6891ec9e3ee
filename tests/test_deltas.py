"""Merge-on-read deltas against a plain list of rows."""
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import MergeAmbiguityError
from tidemark.sinks import lake as L
from tidemark.sinks.deltas import Commit, State, read_log
from tidemark.sinks.lake import LayoutMismatch, compact_lake, delete_from_lake, overwrite_lake, read_lake, read_layout, swap_lake, upsert_lake
from tidemark.streaming.upsert_stream import file_stream, upsert_stream
from test_lake import files_by_bucket

SCHEMA = "k bigint, v string"


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def delta_rows(spark, path, seq):
    return spark.read.parquet(f"{path}/_deltas/_seq={seq}").count()


def test_an_upsert_writes_its_own_rows_only(spark, tmp_dir):
    path = tmp_dir + "/t"
    overwrite_lake(spark, spark.range(4000).select(F.col("id").alias("k"), F.lit("old").alias("v")), path, keys="k", n_buckets=8)
    before = files_by_bucket(path)
    res = upsert_lake(spark, frame(spark, [(i, "new") for i in range(0, 4000, 100)] + [(9000, "ins")]), path, "k", as_delta=True)
    assert (res.source_rows, res.rewritten_buckets) == (41, 0)
    assert files_by_bucket(path) == before and delta_rows(spark, path, 1) == 41
    got = dict(rows(read_lake(spark, path)))
    assert len(got) == 4001 and got[100] == "new" and got[101] == "old" and got[9000] == "ins"
    plan = read_lake(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan  # the base is not shuffled
    # the log has the rows counted: above the bound the keys are not broadcast
    assert rows(read_lake(spark, path, broadcast_rows=0)) == rows(read_lake(spark, path))


def test_compaction_takes_the_worst_buckets_and_drops_what_nobody_reads(spark, tmp_dir):
    path = tmp_dir + "/t"
    overwrite_lake(spark, spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v")), path, keys="k", range_width=100)
    before = files_by_bucket(path)
    upsert_lake(spark, frame(spark, [(i, "a") for i in range(50)] + [(500, "a")]), path, "k", as_delta=True)
    upsert_lake(spark, frame(spark, [(i, "b") for i in range(40, 60)] + [(501, "b")]), path, "k")
    want = rows(read_lake(spark, path))
    assert compact_lake(spark, path, most_buckets=1) == [0]
    assert rows(read_lake(spark, path)) == want and files_by_bucket(path) == before
    assert delta_rows(spark, path, 3) == 100  # one bucket's base
    assert sorted(os.path.basename(d) for d in glob.glob(f"{path}/_deltas/_seq=*")) == ["_seq=1", "_seq=2", "_seq=3"]
    assert compact_lake(spark, path) == [5] and compact_lake(spark, path) == []
    assert rows(read_lake(spark, path)) == want
    assert sorted(os.path.basename(d) for d in glob.glob(f"{path}/_deltas/_seq=*")) == ["_seq=3", "_seq=4"]
    overwrite_lake(spark, read_lake(spark, path), path, keys="k", range_width=100)  # folded: a plain table again
    assert rows(read_lake(spark, path)) == want and read_log(spark, path) == []


class Plain:
    """The table as a list of rows."""

    def __init__(self, data):
        self.data = list(data)

    def drop(self, keys):
        self.data = [r for r in self.data if r[0] is None or r[0] not in keys]

    def put(self, data):
        self.drop({k for k, _ in data})
        self.data += data


@pytest.mark.parametrize("seed", [1])
def test_any_order_of_changes_gives_the_plain_table(spark, tmp_dir, seed):
    rng = random.Random(seed)
    path = tmp_dir + "/t"
    plain = Plain([(i, "base") for i in range(30)] + [(None, "n0")])
    overwrite_lake(spark, frame(spark, plain.data), path, keys="k", n_buckets=4)
    upsert_lake(spark, frame(spark, [(1, "first")]), path, "k", as_delta=True)
    plain.put([(1, "first")])
    for step in range(9):
        op = rng.choice(["merge", "swap", "delete", "compact", "reload", "merge", "swap"])
        keys = rng.sample(range(40), 6)
        if op == "merge":
            data = [(k, f"m{step}") for k in keys] + [(None, f"n{step}")]
            upsert_lake(spark, frame(spark, data), path, "k")
            plain.put(data)
        elif op == "swap":
            data = [(k, f"s{step}-{i}") for k in keys for i in range(rng.choice([1, 2]))]
            swap_lake(spark, frame(spark, data), path, "K")
            plain.put(data)
        elif op == "delete":
            delete_from_lake(spark, frame(spark, [(k,) for k in keys] + [(None,)], "K int"), path, "K")
            plain.drop(set(keys))
        elif op == "compact":
            compact_lake(spark, path, most_buckets=rng.choice([1, 2, None]))
        else:
            plain.data = [r for r in plain.data if r[0] is None or r[0] % 5]
            overwrite_lake(spark, frame(spark, plain.data), path, keys="k", crash_safe=True)
            assert read_log(spark, path)  # switched by the log
        assert rows(read_lake(spark, path)) == rows(frame(spark, plain.data)), (op, step)


def test_a_merge_that_is_ambiguous_leaves_the_table(spark, tmp_dir):
    path = tmp_dir + "/t"
    overwrite_lake(spark, frame(spark, [(1, "a"), (2, "b")]), path, keys="k", n_buckets=4)
    upsert_lake(spark, frame(spark, [(7, "x"), (7, "y")]), path, "k", as_delta=True)  # no target row has the key yet
    before = rows(read_lake(spark, path))
    with pytest.raises(MergeAmbiguityError):
        upsert_lake(spark, frame(spark, [(7, "p"), (7, "q")]), path, "k")
    assert rows(read_lake(spark, path)) == before == [(1, "a"), (2, "b"), (7, "x"), (7, "y")]


def test_a_failed_write_is_not_read_and_its_number_is_used_again(spark, tmp_dir):
    path = tmp_dir + "/t"
    overwrite_lake(spark, frame(spark, [(1, "a")]), path, keys="k", n_buckets=4)
    upsert_lake(spark, frame(spark, [(2, "b")]), path, "k", as_delta=True)
    frame(spark, [(99, "lost")]).selectExpr("*", "false AS _gone", "3 AS _b").write.partitionBy("_b").parquet(f"{path}/_deltas/_seq=2")
    assert rows(read_lake(spark, path)) == [(1, "a"), (2, "b")]
    upsert_lake(spark, frame(spark, [(3, "c")]), path, "k")
    assert rows(read_lake(spark, path)) == [(1, "a"), (2, "b"), (3, "c")]


def test_a_slice_with_null_keys_applied_twice(spark, tmp_dir):
    path = tmp_dir + "/t"
    overwrite_lake(spark, frame(spark, [(1, "a")]), path, keys="k", n_buckets=4)
    src = frame(spark, [(1, "A"), (None, "n")])
    with pytest.raises(ValueError, match="NULL keys"):
        upsert_lake(spark, src, path, "k", refuse_null_keys=True)
    assert rows(read_lake(spark, path)) == [(1, "a")]
    for _ in range(2):
        upsert_lake(spark, src, path, "k", as_delta=True, tag="batch#0", refuse_null_keys=True)
    assert rows(read_lake(spark, path)) == rows(frame(spark, [(1, "A"), (None, "n")]))


def test_stream_batches_as_deltas(spark, tmp_dir):
    path, landing = tmp_dir + "/t", tmp_dir + "/in"
    overwrite_lake(spark, frame(spark, [(i, "old") for i in range(20)]), path, keys="k", n_buckets=4)
    src = frame(spark, [(3, "new"), (None, "n"), (30, "ins")])
    src.coalesce(1).write.parquet(landing)
    q = upsert_stream(file_stream(spark, landing, src.schema), path, "k", tmp_dir + "/ck", as_delta=True, available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    upsert_lake(spark, src, path, "k", tag=f"{tmp_dir}/ck#0")  # the batch again, after a failure
    got = rows(read_lake(spark, path))
    assert len(got) == 22 and (3, "new") in got and (None, "n") in got


def test_states():
    log = [Commit(1, "delta", {1: 5, 2: 1}), Commit(2, "base", {1: 0}), Commit(3, "delta", {1: 2}), Commit(4, "base", {}, whole=True), Commit(5, "delta", {2: 7})]
    assert State.of(log[:1]).pending() == {1: 5, 2: 1} and State.of(log[:3]).pending() == {1: 2, 2: 1}
    assert State.of(log[:3]).used() == {1, 2, 3} and State.of(log[:4]).used() == {4} and State.of(log).used() == {4, 5}
    assert State.of(log).pending() == {2: 7}


def test_crash_safe_reload_stages_when_the_estimate_changes(spark, tmp_dir, monkeypatch):
    path, staged = tmp_dir + "/t", []
    dirs = L.shared_dir
    monkeypatch.setattr(L, "shared_dir", lambda s, name="": staged.append(name) or dirs(s, name))
    overwrite_lake(spark, frame(spark, [(1, "a"), (2, "b")]), path, keys="k")
    stored = read_layout(spark, path).n_buckets
    monkeypatch.setattr(L, "buckets_for", lambda df: stored + 1)  # another estimate at the next load
    overwrite_lake(spark, frame(spark, [(3, "c")]), path, keys="k", crash_safe=True)
    assert staged == ["reload-staging"] and read_layout(spark, path).n_buckets == stored
    assert rows(read_lake(spark, path)) == [(3, "c")]
    # a table without keys before, and one of another layout: staged, then replaced
    overwrite_lake(spark, frame(spark, [(1, "a")]), tmp_dir + "/u")
    with pytest.raises(LayoutMismatch):
        read_layout(spark, tmp_dir + "/u")
    overwrite_lake(spark, frame(spark, [(5, "e")]), tmp_dir + "/u", keys="k", crash_safe=True)
    overwrite_lake(spark, frame(spark, [(6, "f")]), tmp_dir + "/u", keys="k", n_buckets=3, crash_safe=True)
    assert staged == ["reload-staging"] * 3 and read_layout(spark, tmp_dir + "/u").n_buckets == 3
    assert rows(read_lake(spark, tmp_dir + "/u")) == [(6, "f")]


def test_a_failing_source_leaves_the_table_when_staged(spark, tmp_dir):
    path = tmp_dir + "/u"
    overwrite_lake(spark, frame(spark, [(1, "a")]), path)  # no keys yet
    bad = frame(spark, [(1, "x")]).withColumn("v", F.raise_error(F.lit("source is gone")).cast("string"))
    with pytest.raises(Exception, match="source is gone"):
        overwrite_lake(spark, bad, path, keys="k", crash_safe=True)
    assert rows(read_lake(spark, path)) == [(1, "a")]
