"""The run journal, time limits, zone maps."""
import datetime as dt
import glob
import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.plans.journal import JOURNAL_SCHEMA, current_config, read_journal
from tidemark.plans.loads import LoadTask, file_source, load_to_lake, nightly_lake_run, publish_to_warehouse, run_tasks
from tidemark.plans.loads import LakeWarehouse
from tidemark.sinks.lake import compact_lake, overwrite_lake, read_lake, swap_lake, upsert_lake
from tidemark.sinks.zones import read_slice, read_zones, refresh_zones, slice_files
from test_loads_streaming import CFG, write_source

RUN = "2024-05-02"


class Lost(BaseException):
    """The driver goes away."""


def test_a_lost_run_goes_on_with_the_rest(spark, tmp_dir):
    src, lake, journal = tmp_dir + "/src", tmp_dir + "/lake", tmp_dir + "/journal"
    for name in "abcd":
        write_source(spark, src, name, [(1, name, dt.datetime(2024, 4, 1))])
    cfg = spark.createDataFrame([(name, "db", "h", "mt", "id", f"lake_{name}", None, "8", None, "1", None) for name in "abcd"], CFG)
    conns = spark.createDataFrame([("db", "h", "u", "p")], "db_name string, host_port string, username string, passwd string")
    read, loaded = file_source(src), []

    def reader(session, task):
        if len(loaded) == 2:
            raise Lost
        loaded.append(task.tablename)
        return read(session, task)

    with pytest.raises(Lost):
        nightly_lake_run(spark, cfg, conns, RUN, reader, lake, journal=journal, n_buckets=2)
    first, loaded[:] = list(loaded), []
    state = {r.tablename: r.watermark for r in current_config(cfg, read_journal(spark, journal)).collect()}
    assert {t for t, wm in state.items() if wm == RUN} == set(first) and len(first) == 2
    results, after = nightly_lake_run(spark, cfg, conns, RUN, lambda s, t: loaded.append(t.tablename) or read(s, t), lake, journal=journal, n_buckets=2)
    assert sorted(loaded + first) == list("abcd") and results.count() == 2
    assert {(r.watermark, r.comments) for r in after.collect()} == {(RUN, "SUCCESS")}
    assert nightly_lake_run(spark, cfg, conns, RUN, read, lake, journal=journal)[0].count() == 0  # all done


def test_the_last_try_of_every_task_of_a_target_counts(spark):
    cfg = spark.createDataFrame([(t, "db", "h", None, "id", x, wm, "8", None, "1", None) for t, x, wm in
                                 [("a", "one", None), ("b", "one", "2024-01-01"), ("c", "two", None), ("d", "three", "2025-01-01")]], CFG)
    row = lambda day, at, table, target, status, n: (day, at, "db", table, target, "full", status, None, 1.0, n)
    journal = spark.createDataFrame([
        row("2024-05-01", 1, "a", "one", "FAILED", 2), row("2024-05-01", 2, "a", "one", "SUCCESS", 2),  # b was never reached
        row("2024-05-01", 3, "c", "two", "SUCCESS", 1), row("2024-05-02", 9, "c", "two", "FAILED", 1),
        row("2024-05-02", 4, "d", "three", "SUCCESS", 1)], JOURNAL_SCHEMA)
    got = {r.tablename: (r.watermark, r.comments) for r in current_config(cfg, journal).collect()}
    assert got == {"a": (None, "SUCCESS"), "b": ("2024-01-01", "SUCCESS"), "c": ("2024-05-01", "FAILED"), "d": ("2025-01-01", "SUCCESS")}
    more = journal.unionByName(spark.createDataFrame([row("2024-05-01", 7, "b", "one", "SUCCESS", 2)], JOURNAL_SCHEMA))
    assert {r.tablename: r.watermark for r in current_config(cfg, more).collect()}["a"] == "2024-05-01"
    assert rows(current_config(cfg, journal.limit(0))) == rows(cfg)


def test_a_hung_table_is_stopped_alone(spark):
    @F.udf("long")
    def slow(x):
        time.sleep(25)
        return x

    def load(task):
        df = spark.range(0, 4, 1, 1)  # one core is left busy
        (df.select(slow("id")) if task.tablename == "hung" else df).write.format("noop").mode("overwrite").save()

    tasks = [LoadTask(n, "db", n, ("id",)) for n in ("a", "hung", "b")]
    began = time.time()
    got = {r.tablename: (r.status, r.error) for r in run_tasks(spark, tasks, load, parallelism=2, time_limit=6).collect()}
    assert time.time() - began < 60
    assert got["a"][0] == got["b"][0] == "SUCCESS" and got["hung"][0] == "FAILED" and "stopped after 6" in got["hung"][1]
    assert not any(t.startswith("tidemark") for t in spark.sparkContext.getJobTags())


T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)


def test_files_without_due_rows_are_not_opened(spark, tmp_dir):
    path, schema = tmp_dir + "/lake/t", "k bigint, t timestamp_ntz, u timestamp_ntz"
    overwrite_lake(spark, spark.createDataFrame([(i, T0, None) for i in range(60)], schema), path, keys="k", n_buckets=4)
    assert refresh_zones(spark, path, "t|u") == 4 and refresh_zones(spark, path, "t|u") == 0
    old = set(glob.glob(path + "/_b=*/*.parquet"))
    assert read_slice(spark, path, "t|u", "2024-05-01").count() == 0
    upsert_lake(spark, spark.createDataFrame([(100, T1, None)], schema), path, "k")  # a new key: appended to its bucket
    fresh = [(101, T0, T1), (3, T1, None)]
    for row in fresh:
        upsert_lake(spark, spark.createDataFrame([row], schema), path, "k", as_delta=True)
    want = [(3, T1, None), (100, T1, None), (101, T0, T1)]
    for known in (False, True):  # files without a zone are opened, then the map is brought up to date
        opened = slice_files(spark, path, spark.read.parquet(path), ["t", "u"], "2024-05-01")
        assert len(opened) == 1 and not {f.replace("file://", "") for f in opened} & old
        assert rows(read_slice(spark, path, "T|u", "2024-05-01")) == rows(spark.createDataFrame(want, schema))
        if not known:
            assert refresh_zones(spark, path, "t|u") == 1
    for f in old:  # nobody needs them for the slice
        with open(f, "wb") as out:
            out.write(b"not parquet")
    assert rows(read_slice(spark, path, "t|u", "2024-05-01")) == rows(spark.createDataFrame(want, schema))


def test_slices_agree_with_and_without_a_zone_map(spark, tmp_dir):
    path, schema = tmp_dir + "/lake/t", "k bigint, t timestamp_ntz"
    days = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=i * 5)) for i in range(40)] + [(900, None)]
    overwrite_lake(spark, spark.createDataFrame(days, schema), path, keys="k", range_width=10)
    plain = lambda d, n=0: rows(read_slice(spark, path, "t", d, overlap_days=n))
    asked = [("2024-01-01", 0), ("2024-03-11", 0), ("2024-03-11", 30), ("2030-01-01", 0)]
    before = [plain(*a) for a in asked]
    assert read_zones(spark, path) is None and [len(b) for b in before] == [40, 26, 32, 0]
    refresh_zones(spark, path, "t")
    assert [plain(*a) for a in asked] == before
    assert len(slice_files(spark, path, spark.read.parquet(path), ["t"], "2024-03-11")) == 3
    swap_lake(spark, spark.createDataFrame([(39, T0), (1, T1)], schema), path, "k", as_delta=True)  # one isn't due any more
    compact_lake(spark, path, most_buckets=1)
    late = plain("2024-05-20")
    assert {k for k, _ in late} == ({k for k, t in days if t and t >= dt.datetime(2024, 5, 20)} - {39}) | {1}


def test_nightly_loads_keep_zone_maps_and_publish_by_them(spark, tmp_dir):
    src, lake = tmp_dir + "/src", tmp_dir + "/lake"
    write_source(spark, src, "a", [(1, "x", dt.datetime(2024, 4, 1)), (2, "y", dt.datetime(2024, 5, 1))])
    full = LoadTask("a", "db", "t_a", ("id",), ("mt",), None, "full", mapping={"mt": "changed"})
    load_to_lake(spark, full, file_source(src), lake, n_buckets=4, zones=True)
    assert read_zones(spark, lake + "/t_a").select("hi.*").columns == ["changed"]
    wh = LakeWarehouse(tmp_dir + "/wh", n_buckets=4)
    publish_to_warehouse(spark, full, lake, wh)
    inc = LoadTask("a", "db", "t_a", ("id",), ("mt",), "2024-05-01", "incremental", mapping={"mt": "changed"})
    write_source(spark, src, "a", [(2, "Y", dt.datetime(2024, 5, 2)), (3, "z", dt.datetime(2024, 5, 2))])
    load_to_lake(spark, inc, file_source(src), lake, as_delta=True, zones=True)
    publish_to_warehouse(spark, inc, lake, wh)
    assert rows(wh.read(spark, "t_a").select("id", "name")) == rows(read_lake(spark, lake + "/t_a").select("id", "name")) == [(1, "x"), (2, "Y"), (3, "z")]


def test_a_named_table_is_loaded_in_full_and_refuses_what_its_format_lacks(spark, tmp_dir):
    src = tmp_dir + "/src"
    write_source(spark, src, "a", [(1, "x", dt.datetime(2024, 4, 1))])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS named LOCATION '{tmp_dir}/named'")
    full = LoadTask("a", "db", "t_a", ("id",), ("mt",), None, "full", catalog_table="named.t_a")
    inc = LoadTask("a", "db", "t_a", ("id",), ("mt",), "2024-03-01", "incremental", catalog_table="named.t_a")
    assert load_to_lake(spark, full, file_source(src), tmp_dir) == "named.t_a"
    assert spark.table("named.t_a").count() == 1
    [r] = run_tasks(spark, [inc], lambda t: load_to_lake(spark, t, file_source(src), tmp_dir)).collect()
    assert r.status == "FAILED" and "MERGE" in r.error.upper()  # parquet tables have no row-level operations
    spark.sql("DROP DATABASE named CASCADE")
