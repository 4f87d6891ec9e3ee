import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tidemark.plans.loads import (
    LakeWarehouse, LoadTask, file_source, load_to_warehouse, nightly_lake_run, publish_to_warehouse, run_tasks,
)
from tidemark.sinks.lake import overwrite_lake, read_lake
from tidemark.streaming import file_stream, upsert_stream

RUN = "2024-05-02"
CFG = ("tablename string, dbname string, host_port string, timecols string, primarykeys string, "
       "targettable string, watermark string, dbversion string, mappings string, status string, comments string")


def write_source(spark, root, name, data):
    df = spark.createDataFrame(data, "id bigint, name string, mt timestamp_ntz")
    df.write.mode("overwrite").parquet(f"{root}/{name}.parquet")


def test_nightly_run_loads_isolates_failures_and_advances_watermarks(spark, tmp_dir):
    src, lake = tmp_dir + "/src", tmp_dir + "/lake"
    write_source(spark, src, "a", [(1, "x", dt.datetime(2024, 4, 1)), (2, "y", dt.datetime(2024, 5, 1))])
    cfg = spark.createDataFrame([
        ("a", "db", "h", "mt", "id", "lake_a", None, "8", '{"name": "nm"}', "1", None),
        ("missing", "db", "h", None, "id", "lake_missing", None, "8", None, "1", None),
        ("a", "db", "h", "mt", "id", "lake_bad", "2024-04-15", "8", '{"x": ', "1", None),
    ], CFG)
    conns = spark.createDataFrame([("db", "h", "u", "p")], "db_name string, host_port string, username string, passwd string")
    results, new_cfg = nightly_lake_run(spark, cfg, conns, RUN, file_source(src), lake, parallelism=2)
    status = {r.targettable: r.status for r in results.collect()}
    assert status == {"lake_a": "SUCCESS", "lake_missing": "FAILED", "lake_bad": "FAILED"}
    assert read_lake(spark, lake + "/lake_a").columns == ["id", "nm", "mt"]
    wm = {r.targettable: (r.watermark, r.comments) for r in new_cfg.collect()}
    assert wm["lake_a"] == (RUN, "SUCCESS") and wm["lake_bad"] == ("2024-04-15", "FAILED")

    # next day: source changed; the incremental run merges only the new slice
    write_source(spark, src, "a", [(1, "x", dt.datetime(2024, 4, 1)), (2, "Y", dt.datetime(2024, 5, 2)),
                                   (3, "z", dt.datetime(2024, 5, 3))])
    results2, cfg2 = nightly_lake_run(spark, new_cfg.filter(F.col("targettable") == "lake_a").cache(), conns,
                                      "2024-05-03", file_source(src), lake)
    assert [r.status for r in results2.collect()] == ["SUCCESS"]
    assert rows(read_lake(spark, lake + "/lake_a").select("id", "nm")) == [(1, "x"), (2, "Y"), (3, "z")]


def test_publish_and_direct_warehouse_loads(spark, tmp_dir):
    src, lake = tmp_dir + "/src", tmp_dir + "/lake"
    wh = LakeWarehouse(tmp_dir + "/wh", n_buckets=4)
    write_source(spark, src, "a", [(1, "x", dt.datetime(2024, 4, 1)), (2, "y", dt.datetime(2024, 5, 1))])
    full = LoadTask("a", "db", "t_a", ("id",), ("mt",), None, "full")
    overwrite_lake(spark, file_source(src)(spark, full), lake + "/t_a", keys="id", n_buckets=4)
    publish_to_warehouse(spark, full, lake, wh)
    assert wh.read(spark, "t_a").count() == 2
    inc = LoadTask("a", "db", "t_a", ("id",), ("mt",), "2024-05-01", "incremental")
    write_source(spark, src, "a", [(2, "Y", dt.datetime(2024, 5, 2)), (3, "z", dt.datetime(2024, 5, 2))])
    load_to_warehouse(spark, inc, file_source(src), wh)
    assert rows(wh.read(spark, "t_a").select("id", "name")) == [(1, "x"), (2, "Y"), (3, "z")]


def test_run_tasks_skips_and_reports(spark):
    tasks = [LoadTask("a", "db", "ta", ("id",), load_mode="skip"), LoadTask("b", "db", "tb", ("id",))]
    out = run_tasks(spark, tasks, lambda t: 1 / 0)
    r = out.collect()
    assert len(r) == 1 and r[0].status == "FAILED" and "ZeroDivisionError" in r[0].error


def test_streaming_upsert(spark, tmp_dir):
    lake, landing, ckpt = tmp_dir + "/lake/t", tmp_dir + "/landing", tmp_dir + "/ckpt"
    base = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1)), (2, "b", dt.datetime(2024, 1, 1))],
                                 "id bigint, name string, mt timestamp_ntz")
    overwrite_lake(spark, base, lake, keys="id", n_buckets=4)
    spark.createDataFrame([(2, "B", dt.datetime(2024, 2, 1))], base.schema).write.parquet(landing + "/f1")
    spark.createDataFrame([(3, "C", dt.datetime(2024, 2, 2)), (9, "old", dt.datetime(2023, 1, 1))],
                          base.schema).write.mode("append").parquet(landing + "/f1")
    stream = file_stream(spark, landing + "/f1", base.schema, max_files_per_trigger=1, time_cols="mt",
                         watermark="2024-01-15")
    q = upsert_stream(stream, lake, "id", ckpt, n_buckets=4, available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    assert rows(read_lake(spark, lake).select("id", "name")) == [(1, "a"), (2, "B"), (3, "C")]


def test_config_written_back_to_its_own_path(spark, tmp_dir):
    src, lake, cfg_path = tmp_dir + "/src", tmp_dir + "/lake", tmp_dir + "/config"
    write_source(spark, src, "a", [(1, "x", dt.datetime(2024, 4, 1))])
    spark.createDataFrame([("a", "db", "h", "mt", "id", "lake_a", None, "8", None, "1", None)], CFG) \
        .write.parquet(cfg_path)
    conns = spark.createDataFrame([("db", "h", "u", "p")], "db_name string, host_port string, username string, passwd string")
    cfg = spark.read.parquet(cfg_path)
    _, new_cfg = nightly_lake_run(spark, cfg, conns, RUN, file_source(src), lake)
    overwrite_lake(spark, new_cfg, cfg_path)  # reads cfg_path while replacing it: staged first
    got = spark.read.parquet(cfg_path).collect()
    assert [(r.tablename, r.watermark, r.comments) for r in got] == [("a", RUN, "SUCCESS")]


def test_nightly_full_reload_crash_safe(spark, tmp_dir):
    src, lake = tmp_dir + "/src", tmp_dir + "/lake"
    cfg = spark.createDataFrame([("a", "db", "h", None, "id", "lake_a", None, "8", None, "1", None)], CFG)
    conns = spark.createDataFrame([("db", "h", "u", "p")], "db_name string, host_port string, username string, passwd string")
    write_source(spark, src, "a", [(i, "x", dt.datetime(2024, 4, 1)) for i in range(20)])
    nightly_lake_run(spark, cfg, conns, "2024-05-01", file_source(src), lake, crash_safe=True)
    write_source(spark, src, "a", [(1, "y", dt.datetime(2024, 4, 1))])
    res, _ = nightly_lake_run(spark, cfg, conns, "2024-05-02", file_source(src), lake, crash_safe=True)
    assert [r.status for r in res.collect()] == ["SUCCESS"]
    assert rows(read_lake(spark, lake + "/lake_a").select("id", "name")) == [(1, "y")]
