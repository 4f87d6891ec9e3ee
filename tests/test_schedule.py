
from tidemark.plans.schedule import (
    apply_run_results, apply_unique_results, build_schedule, parse_tasks, pending_tasks, with_load_mode,
)

RUN = "2024-05-02"
CFG = ("TABLENAME string, DBNAME string, HOST_PORT string, TIMECOLS string, PRIMARYKEYS string, TARGETTABLE string, "
       "WATERMARK string, DBVERSION string, MAPPINGS string, STATUS string, COMMENTS string")
CONN = "DB_NAME string, HOST_PORT string, USERNAME string, PASSWD string"


def config(spark):
    return spark.createDataFrame([
        ("t_full", "db1", "h:1", None, "id", "dw_full", None, "8", None, "1", None),
        ("t_today", "db1", "h:1", "ct", "id", "dw_today", RUN, "8", None, "1", None),
        ("t_inc", "db1", "h:1", "ct|mt|", "id|shop", "dw_inc", "2024-04-01", "8", '{"a": "b", "b": "a"}', "1", None),
        ("t_future", "db1", "h:1", "ct", "id", "dw_future", "2030-01-01", "8", None, "1", None),
        ("t_nowm", "db1", "h:1", "ct", "id", "dw_nowm", None, "8", None, "1", None),
        ("t_off", "db1", "h:1", "ct", "id", "dw_off", None, "8", None, "0", None),
        ("t_badjson", "db1", "h:1", "ct", "id", "dw_bad", "2024-04-01", "8", '{"a": ', "1", None),
        ("t_noconn", "db9", "h:9", None, "id", "dw_noconn", None, "8", None, "1", None),
        ("t_nopw", "db2", "h:2", None, "id", "dw_nopw", None, "8", None, "1", None),
    ], CFG)


def connections(spark):
    return spark.createDataFrame([
        ("db1", "x", "u1", "pw"), ("db1", "y", "u1", "pw"),  # duplicates apart from the dropped host
        ("db2", "x", "u2", None),
    ], CONN)


def test_pending_and_schedule(spark):
    cfg = config(spark)
    assert pending_tasks(cfg.toDF(*[c.lower() for c in cfg.columns]), RUN).count() == 8
    sched = build_schedule(cfg, connections(spark), RUN)
    names = sorted(r.tablename for r in sched.collect())
    assert names == ["t_badjson", "t_full", "t_future", "t_inc", "t_nowm"]
    assert sched.columns[-4:] == ["username", "passwd", "dbversion", "mappings"]


def test_parse_and_modes(spark):
    sched = build_schedule(config(spark), connections(spark), RUN)
    modes = {r.tablename: r for r in with_load_mode(parse_tasks(sched), RUN).collect()}
    assert modes["t_full"].load_mode == "full" and modes["t_full"].write_mode == "overwrite"
    assert modes["t_nowm"].load_mode == "full"
    inc = modes["t_inc"]
    assert inc.load_mode == "incremental" and inc.is_incremental
    assert inc.time_cols == ["ct", "mt"] and inc.primary_keys == ["id", "shop"]
    assert inc.mapping == {"a": "b", "b": "a"} and not inc.mapping_error
    assert inc.url == "jdbc:mysql://h:1"
    assert modes["t_future"].load_mode == "incremental"
    assert modes["t_badjson"].mapping_error and modes["t_badjson"].mapping is None


def test_skip_mode_when_whole_config_passed(spark):
    cfg = config(spark)
    tasks = parse_tasks(cfg.toDF(*[c.lower() for c in cfg.columns]))
    modes = {r.tablename: r.load_mode for r in with_load_mode(tasks, RUN).collect()}
    assert modes["t_today"] == "skip"


def test_apply_run_results(spark):
    cfg = config(spark)
    results = spark.createDataFrame(
        [("dw_inc", "SUCCESS"), ("dw_bad", "FAILED"), ("dw_full", "SUCCESS"), ("dw_full", "FAILED")],
        "targettable string, status string")
    out = {r.tablename: (r.watermark, r.comments) for r in apply_run_results(cfg, results, RUN).collect()}
    assert out["t_inc"] == (RUN, "SUCCESS")
    assert out["t_badjson"] == ("2024-04-01", "FAILED")
    assert out["t_full"] == (None, "FAILED")
    assert out["t_off"] == (None, None)
    assert len(out) == 9


def test_apply_unique_results(spark):
    cfg = config(spark)
    chk = spark.createDataFrame([("db1", "t_inc", "Not Unique")], "dbname string, tablename string, comment string")
    out = {r.tablename: r.comments for r in apply_unique_results(cfg, chk).collect()}
    assert out["t_inc"] == "Not Unique" and out["t_full"] is None
