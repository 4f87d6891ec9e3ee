import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import incremental_filter, incremental_join, zero_dates_to_null
from tidemark.functions.watermark import parse_run_date

WM = "2024-03-10"
EPOCH_S = int(dt.datetime(2024, 3, 10, tzinfo=dt.timezone.utc).timestamp())


def test_inclusive_bound_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 3, 10), None), (2, dt.datetime(2024, 3, 9, 23, 59), None),
         (3, None, dt.datetime(2024, 3, 11)), (4, None, None), (5, dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 10))],
        "id int, created timestamp, modified timestamp")
    out = incremental_filter(df, "created|modified", WM)
    assert sorted(r.id for r in out.collect()) == [1, 3, 5]


def test_timestamp_ntz_and_date_and_string(spark):
    df = spark.createDataFrame([(1, "2024-03-10 00:00:00"), (2, "2024-03-09 12:00:00")], "id int, s string")
    df = df.withColumns({"ntz": F.to_timestamp_ntz("s"), "d": F.to_date("s")})
    for c in ["ntz", "d", "s"]:
        assert sorted(r.id for r in incremental_filter(df, c, WM).collect()) == [1], c


def test_epoch_seconds_and_millis(spark):
    df = spark.createDataFrame([(1, EPOCH_S, EPOCH_S * 1000), (2, EPOCH_S - 1, EPOCH_S * 1000 - 1)],
                               "id int, s bigint, ms bigint")
    assert [r.id for r in incremental_filter(df, "s", WM, unit="s").collect()] == [1]
    assert [r.id for r in incremental_filter(df, "ms", WM, unit="ms").collect()] == [1]


def test_overlap_days(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 3, 8)), (2, dt.date(2024, 3, 7))], "id int, d date")
    assert [r.id for r in incremental_filter(df, "d", WM, overlap_days=2).collect()] == [1]


def test_bad_inputs(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 3, 8))], "id int, d date")
    with pytest.raises(ValueError):
        incremental_filter(df, "d", "2024/03/10")
    with pytest.raises(ValueError):
        incremental_filter(df, "nope", WM)
    with pytest.raises(ValueError):
        incremental_filter(df, "", WM)
    assert parse_run_date(dt.date(2024, 1, 2)) == "2024-01-02"


def test_filter_pushed_to_scan(spark, tmp_dir):
    df = spark.createDataFrame([(1, dt.datetime(2024, 3, 10))], "id int, ts timestamp_ntz")
    df.write.parquet(tmp_dir + "/t")
    plan = incremental_filter(spark.read.parquet(tmp_dir + "/t"), "ts", WM)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan


def test_incremental_join_matches_brute_force(spark):
    left = spark.createDataFrame(
        [(1, 1, dt.date(2024, 3, 11)), (2, 1, dt.date(2024, 1, 1)), (3, 2, None), (4, 3, dt.date(2024, 3, 10)),
         (5, 9, dt.date(2024, 3, 12))], "lid int, k int, lt date")
    right = spark.createDataFrame(
        [(1, dt.date(2024, 3, 10)), (2, dt.date(2024, 1, 1)), (3, None), (3, dt.date(2024, 2, 1))],
        "k int, rt date")
    got = incremental_join(left, right, "k", "lt", "rt", WM).select("lid", "k", "lt", "rt")
    brute = left.join(right, "k").filter((F.col("lt") >= F.lit(WM).cast("date")) | (F.col("rt") >= F.lit(WM).cast("date")))
    assert rows(got) == rows(brute.select("lid", "k", "lt", "rt"))


def test_zero_dates(spark):
    df = spark.createDataFrame([(1, "0000-00-00 00:00:00"), (2, "2024-01-02 03:04:05"), (3, None)], "id int, d string")
    out = {r.id: r.d for r in zero_dates_to_null(df, "d").collect()}
    assert out == {1: None, 2: dt.datetime(2024, 1, 2, 3, 4, 5), 3: None}


def test_epoch_bound_ignores_session_time_zone(spark):
    df = spark.createDataFrame([(1, EPOCH_S), (2, EPOCH_S - 1)], "id int, s bigint")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert [r.id for r in incremental_filter(df, "s", WM).collect()] == [1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    # the source's own clock can be named explicitly
    la = incremental_filter(df, "s", WM, tz="America/Los_Angeles").collect()
    assert la == []


def test_time_columns_match_case_insensitively(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 3, 10)), (2, dt.date(2024, 3, 1))], "id int, CREATE_TIME date")
    assert [r.id for r in incremental_filter(df, "create_time", WM).collect()] == [1]
