import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import (
    MergeAmbiguityError, ambiguous_target_rows, delete_by_keys, matched_by_keys, merge_metrics, merge_upsert,
    stage_swap,
)

SCHEMA = "k int, k2 string, v string"


def frames(spark, target, source):
    return spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)


def test_merge_updates_inserts_and_keeps(spark):
    t, s = frames(spark, [(1, "a", "old"), (2, "a", "old"), (3, "a", "keep")],
                  [(1, "a", "new"), (4, "a", "ins")])
    assert rows(merge_upsert(t, s, "k|k2")) == [(1, "a", "new"), (2, "a", "old"), (3, "a", "keep"), (4, "a", "ins")]


def test_null_keys_never_match(spark):
    t, s = frames(spark, [(None, "a", "t"), (1, None, "t")], [(None, "a", "s"), (1, None, "s")])
    out = rows(merge_upsert(t, s, "k|k2"))
    assert len(out) == 4  # old rows stay, new rows are added
    assert rows(stage_swap(t, s, "k|k2")) == out


def test_duplicate_source_key_with_match_raises(spark):
    t, s = frames(spark, [(1, "a", "old")], [(1, "a", "x"), (1, "a", "y")])
    with pytest.raises(MergeAmbiguityError):
        merge_upsert(t, s, "k|k2")
    assert rows(ambiguous_target_rows(t, s, "k|k2")) == [(1, "a", "old")]
    # stage-and-swap keeps both stage rows
    assert rows(stage_swap(t, s, "k|k2")) == [(1, "a", "x"), (1, "a", "y")]


def test_duplicate_source_key_without_match_inserts_both(spark):
    t, s = frames(spark, [(1, "a", "old")], [(2, "a", "x"), (2, "a", "y")])
    assert rows(merge_upsert(t, s, "k|k2")) == [(1, "a", "old"), (2, "a", "x"), (2, "a", "y")]


def test_empty_sides(spark):
    t, s = frames(spark, [(1, "a", "old")], [])
    assert rows(merge_upsert(t, s, "k")) == [(1, "a", "old")]
    t, s = frames(spark, [], [(1, "a", "new")])
    assert rows(merge_upsert(t, s, "k")) == [(1, "a", "new")]


def test_reordered_and_missing_columns(spark):
    t, s = frames(spark, [(1, "a", "old")], [(1, "a", "new")])
    s2 = s.select("v", "k2", "k")
    out = merge_upsert(t, s2, "k")
    assert out.columns == t.columns and rows(out) == [(1, "a", "new")]
    with pytest.raises(ValueError):
        merge_upsert(t, s.drop("v"), "k")
    with pytest.raises(ValueError):
        merge_upsert(t, s.withColumn("extra", F.lit(1)), "k")


def test_source_types_cast_to_target(spark):
    t = spark.createDataFrame([(1, "old")], "k bigint, v string")
    s = spark.createDataFrame([(1, "new")], "k int, v string")
    out = merge_upsert(t, s, "k")
    assert dict(out.dtypes)["k"] == "bigint" and rows(out) == [(1, "new")]


def test_upsert_is_idempotent(spark):
    t, s = frames(spark, [(1, "a", "old"), (2, "a", "old")], [(2, "a", "new"), (3, "a", "ins")])
    once = merge_upsert(t, s, "k")
    twice = merge_upsert(once, s, "k")
    assert rows(once) == rows(twice)


def test_merge_metrics_add_up(spark):
    t, s = frames(spark, [(1, "a", "o"), (2, "a", "o"), (3, "a", "o"), (None, "a", "o")],
                  [(2, "a", "n"), (9, "a", "n"), (None, "a", "n")])
    m = merge_metrics(t, s, "k").first().asDict()
    assert m == {"rows_updated": 1, "rows_inserted": 2, "rows_untouched": 3, "rows_after": 6}
    assert merge_upsert(t, s, "k").count() == m["rows_after"]


def test_delete_and_match_by_keys(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k bigint, v string")
    keys = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(delete_by_keys(t, keys, "k")) == [(2, "b"), (None, "c")]
    assert rows(matched_by_keys(t, keys, "k")) == [(1, "a")]
    assert rows(delete_by_keys(t, keys, "k", keys_as_decimal=True)) == [(2, "b"), (None, "c")]


def test_large_key_side_is_not_broadcast(spark):
    t, s = frames(spark, [(i, "a", "o") for i in range(50)], [(i, "a", "n") for i in range(0, 50, 2)])
    out = merge_upsert(t, s, "k", broadcast_rows=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan or "AdaptiveSparkPlan" in plan
    assert sorted(r.v for r in out.collect()).count("n") == 25


def test_merge_metrics_both_plans_agree(spark):
    t = spark.createDataFrame([(i % 7 if i < 20 else i, "a", "o") for i in range(40)] + [(None, "a", "o")], SCHEMA)
    s = spark.createDataFrame([(i, "a", "n") for i in range(0, 60, 3)] + [(None, "a", "n"), (3, "a", "dup")], SCHEMA)
    small = merge_metrics(t, s, "k").first().asDict()
    large = merge_metrics(t, s, "k", broadcast_rows=2).first().asDict()
    assert small == large
    assert small["rows_after"] == small["rows_untouched"] + s.count()


def test_source_names_match_case_insensitively(spark):
    t = spark.createDataFrame([(1, "old")], "id bigint, v string")
    s = spark.createDataFrame([(1, "new"), (2, "ins")], "ID bigint, V string")
    out = merge_upsert(t, s, "id")
    assert out.columns == ["id", "v"] and rows(out) == [(1, "new"), (2, "ins")]
