"""Cases where a load must fail, keep its rows, or compare exactly."""
import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import delete_by_keys, distinct_keys, duplicate_keys, unique_check
from tidemark.operators.sizing import at_most, measured
from tidemark.plans.ddl import target_ddl
from tidemark.plans.loads import LakeWarehouse, LoadTask, load_to_lake, load_to_warehouse, run_tasks, source_slice, split_key
from tidemark.plans.schedule import apply_unique_results
from tidemark.sinks.lake import read_lake
from tidemark.sources.catalog import catalog_frame, profile_catalog, schema_catalog
from tidemark.sources.jdbc import splittable_field, staging_name

SCHEMA = "id bigint, v string, t timestamp_ntz"
DAY = datetime.datetime(2024, 4, 20)


def task(mode, keys=("id",), **kw):
    return LoadTask("t", "db", "t", keys, ("t",), "2024-04-15", mode, **kw)


def source(spark, rows_):
    df = spark.createDataFrame(rows_, SCHEMA)
    return lambda s, t: df


def test_incremental_load_without_its_table_fails_and_says_so(spark, tmp_dir):
    reader = source(spark, [(1, "a", datetime.datetime(2024, 1, 1)), (2, "b", DAY)])
    [r] = run_tasks(spark, [task("incremental")], lambda t: load_to_lake(spark, t, reader, tmp_dir)).collect()
    assert r.status == "FAILED" and "does not exist" in r.error


def test_keyless_tables_load_in_full(spark, tmp_dir):
    reader = source(spark, [(1, "a", DAY), (1, "a", DAY)])
    path = load_to_lake(spark, task("full", ()), reader, tmp_dir)
    assert read_lake(spark, path).count() == 2
    warehouse = LakeWarehouse(tmp_dir + "/wh")
    load_to_warehouse(spark, task("full", ()), reader, warehouse)
    assert warehouse.read(spark, "t").count() == 2
    with pytest.raises(ValueError, match="primary keys"):
        load_to_lake(spark, task("incremental", ()), reader, tmp_dir)


def test_errors_are_kept_whole(spark):
    def fail(t):
        raise RuntimeError("first line\n" + "x" * 5000)

    [r] = run_tasks(spark, [task("full")], fail).collect()
    assert r.error == "RuntimeError: first line\n" + "x" * 5000


def test_task_clock_and_overlap(spark):
    midnight = int(datetime.datetime(2024, 4, 15, tzinfo=datetime.timezone.utc).timestamp())
    df = spark.createDataFrame([(1, midnight - 5 * 3600), (2, midnight - 9 * 3600), (3, midnight + 1), (4, midnight - 30 * 3600)], "id bigint, t bigint")
    got = lambda **kw: sorted(r.id for r in source_slice(spark, task("incremental", **kw), lambda s, t: df).collect())
    assert got() == [3]
    assert got(tz="Asia/Shanghai") == [1, 3]  # 03:00 at +8 of the watermark's day
    assert got(overlap_days=1) == [1, 2, 3]
    ms = df.withColumn("t", F.col("t") * 1000)
    assert sorted(r.id for r in source_slice(spark, task("incremental", epoch_unit="ms"), lambda s, t: ms).collect()) == [3]


def test_split_key_of_a_task(spark):
    assert split_key(task("full", ("a", "b"))) == "a"
    assert split_key(task("full", ("a",), read_key="r")) == "r" and split_key(task("full", ()), "k") == "k"
    assert split_key(task("full", ())) is None
    df = spark.createDataFrame([], "Id bigint, name string, d date")
    assert [splittable_field(df, k) for k in ("ID", "name", "d", "x", None)] == ["Id", None, "d", None, None]
    assert staging_name("DW.t") != staging_name("DW.t")


def test_control_rows_are_not_multiplied(spark):
    cfg = spark.createDataFrame([("t", "db", "a", None), ("t", "db", "b", None), ("u", "db", "c", "kept")],
                                "tablename string, dbname string, targettable string, comments string")
    checks = spark.createDataFrame([("t", "db", "Unique"), ("t", "db", "Not Unique")], "tablename string, dbname string, comment string")
    got = rows(apply_unique_results(cfg, checks))
    assert got == [("t", "db", "a", "Not Unique"), ("t", "db", "b", "Not Unique"), ("u", "db", "c", "kept")]


def test_fractional_keys_are_not_rounded(spark):
    target = spark.createDataFrame([("1.0",), ("1.4",), ("2",)], "k string")
    keys = spark.createDataFrame([("1.00",), ("2.0",)], "k string")
    assert rows(delete_by_keys(target, keys, "k", keys_as_decimal=True)) == [("1.4",)]


def test_key_names_with_dots(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "`a.b` int, c int")
    assert rows(distinct_keys(df, "a.b")) == [(1,)] and duplicate_keys(df, "a.b").count() == 1
    assert not unique_check(df, "a.b").first().is_unique


def test_sizes_are_measured_in_bytes(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 10_000).alias("s"))
    n, size = measured(df)
    assert n == 100 and 1_000_000 < size < 1_100_000
    assert at_most(df, 100) and not at_most(df, 99) and not at_most(df, 100, 1 << 16)
    plan = df.agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan


def test_ddl_renames_as_the_load_does(spark):
    cat = catalog_frame(spark, [("t", 1, "ID", "int"), ("t", 2, "note", "varchar(2000)")])
    r = target_ddl(cat, renames={"t": {"id": "oid"}}).first()
    assert '"oid"' in r.ddl and r.n_narrowed == 1 and not r.ok  # 2,000 characters don't fit varchar2(1000)


def test_text_types_count_bytes(spark):
    df = spark.createDataFrame([("Ä" * 40_000,)], "s string")
    assert profile_catalog({"t": df}).first().src_type == "mediumtext"
    assert [tuple(r) for r in schema_catalog({"t": df}).collect()] == [("t", 1, "s", "text")]


def test_target_tables_are_created_from_the_schedule(spark):
    from tidemark.plans.loads import create_targets

    cat = catalog_frame(spark, [("a", 1, "ID", "int"), ("a", 2, "v", "varchar(20)"), ("b", 1, "j", "json"), ("c", 1, "id", "int"), ("x", 1, "id", "int")])
    tasks = [LoadTask("a", "db", "dw_a", ("id",), mapping={"id": "pk"}), LoadTask("b", "db", "dw_b", ("j",)), LoadTask("c", "db", "dw_c", ("id",))]
    ran = []

    def execute(statements):
        if "dw_c" in statements[0]:
            raise RuntimeError("no space")
        ran.extend(statements)

    got = {r.tablename: (r.status, r.error) for r in create_targets(spark, tasks, cat, execute).collect()}
    assert got == {"a": ("SUCCESS", None), "b": ("REFUSED", None), "c": ("FAILED", "RuntimeError: no space")}
    assert ran == ['create table DW.dw_a ( "pk" number(12,0),"v" varchar2(1000) )']


def test_merge_into_needs_a_format_with_merge(spark):
    from pyspark.errors import AnalysisException
    from tidemark.sinks.lake import merge_into_table

    spark.range(3).write.mode("overwrite").saveAsTable("plain_target")
    try:
        with pytest.raises(Exception) as caught:
            merge_into_table(spark.range(5), "plain_target", "id")
        assert isinstance(caught.value, AnalysisException) or "MERGE" in str(caught.value)
    finally:
        spark.sql("DROP TABLE plain_target")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_dates_fail_whatever_the_session(spark, ansi):
    from tidemark.operators import zero_dates_to_null

    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good = spark.createDataFrame([("2024-01-02 03:04:05",), ("0000-00-00 00:00:00",), (None,)], "d string")
        assert [r.d for r in zero_dates_to_null(good, "d").collect()] == [datetime.datetime(2024, 1, 2, 3, 4, 5), None, None]
        with pytest.raises(Exception):
            zero_dates_to_null(spark.createDataFrame([("soon",)], "d string"), "d").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("seed", range(3))
def test_both_sides_of_a_size_switch_give_the_same_rows(spark, seed):
    import random

    from tidemark.operators import incremental_join, matched_by_keys, merge_metrics, merge_upsert, stage_swap

    rng = random.Random(seed)
    value = lambda: rng.choice([None, *range(8)])
    frame = lambda n: spark.createDataFrame([(value(), value(), rng.randrange(100)) for _ in range(n)], "a int, b int, v int")
    t, s = frame(40), frame(12).dropDuplicates(["a", "b"])
    for op in (merge_metrics, merge_upsert, stage_swap, delete_by_keys, matched_by_keys):
        assert rows(op(t, s, "a|b", broadcast_rows=0)) == rows(op(t, s, "a|b", broadcast_rows=1000)), op
    day = lambda df, c: df.withColumn(c, F.expr("date_add(date'2024-01-01', v)"))
    left, right = day(t, "t1"), day(s, "t2").withColumnRenamed("v", "w").withColumnRenamed("b", "b2")
    joined = [rows(incremental_join(left, right, "a", "t1", "t2", "2024-02-10", broadcast_rows=n)) for n in (0, 1000)]
    assert joined[0] == joined[1]
