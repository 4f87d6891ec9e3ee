"""Plan shapes the scale design depends on (checked on the physical plan text)."""
import pytest

from conftest import SF_SMALL
from tidemark.operators import incremental_filter, incremental_join, merge_metrics, merge_upsert, rename_columns


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SF_SMALL}/orders.parquet")


def test_incremental_merge_never_shuffles_the_target(spark, orders):
    src = incremental_filter(orders, "o_orderdate", "2001-07-01")
    p = plan(merge_upsert(orders, src, "o_orderkey"))
    assert "BroadcastHashJoin" in p and "LeftAnti" in p
    assert "SortMergeJoin" not in p and "ShuffledHashJoin" not in p


def test_watermark_filter_and_key_pruning_reach_the_scan(spark, orders):
    p = plan(incremental_filter(orders, "o_orderdate", "2001-07-01").select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate," in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in p


def test_incremental_join_broadcasts_both_slices(spark, orders):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_shipdate")
    od = rename_columns(orders.select("o_orderkey", "o_orderdate"), {"o_orderkey": "l_orderkey"})
    p = plan(incremental_join(li, od, "l_orderkey", "l_shipdate", "o_orderdate", "2001-07-01"))
    assert p.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in p


def test_merge_metrics_small_source_has_no_shuffle_join(spark, orders):
    src = incremental_filter(orders, "o_orderdate", "2001-07-01")
    p = plan(merge_metrics(orders, src, "o_orderkey"))
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" in p
