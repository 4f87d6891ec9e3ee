from tidemark.functions.typemap import map_types
from tidemark.plans.ddl import target_ddl
from tidemark.sources.catalog import catalog_frame, profile_catalog

# (source type, expected target, expected status)
TRUTH = [
    ("varchar(255)", "varchar2(1000)", "ok"),
    ("varchar(2000)", "varchar2(1000)", "narrowed"),
    ("tinyint(4)", "number(5,0)", "ok"),
    ("tinyint", "number(5,0)", "ok"),
    ("smallint(6)", "number(7,0)", "ok"),
    ("mediumint(9)", "number(9,0)", "ok"),
    ("bigint(20)", "number(24,0)", "ok"),
    ("bigint unsigned", "number(24,0)", "ok"),
    ("int", "number(12,0)", "ok"),
    ("int(10)", "number(12,0)", "ok"),
    ("int(11) unsigned", "number(12,0)", "ok"),
    ("double", "number", "ok"),
    ("double(10,2)", "number(10,2)", "ok"),
    ("float", "number", "ok"),
    ("decimal(11,2)", "number(11,2)", "ok"),
    ("datetime", "timestamp", "ok"),
    ("datetime(3)", "timestamp(3)", "ok"),
    ("timestamp", "timestamp", "ok"),
    ("timestamp(6)", "timestamp", "ok"),
    ("bit(1)", "number(2,0)", "ok"),
    ("text", "clob", "ok"),
    ("mediumtext", "clob", "ok"),
    ("longtext", "clob", "ok"),
    ("long", "varchar2(4000)", "ok"),
    ("date", "date", "ok"),
    ("char(10)", "char(10)", "ok"),
    ("blob", "blob", "ok"),
    ("bit(8)", None, "unsupported"),
    ("tinytext", None, "unsupported"),
    ("time", None, "unsupported"),
    ("year(4)", None, "unsupported"),
    ("json", None, "unsupported"),
    ("enum('a','b')", None, "unsupported"),
]


def test_truth_table(spark):
    cat = catalog_frame(spark, [("t", i, f"c{i}", s) for i, (s, _, _) in enumerate(TRUTH, 1)])
    got = {r.src_type: (r.tgt_type, r.map_status) for r in map_types(cat).collect()}
    for src, tgt, status in TRUTH:
        assert got[src] == (tgt, status), src


def test_ddl_with_long_names_and_renames(spark):
    rows = [("t_points_account", 1, "id", "bigint(20)"),
            ("t_points_account", 2, "points_second_background_picture", "varchar(255)"),
            ("t_points_account", 3, "create_time", "datetime")]
    cat = catalog_frame(spark, rows)
    r = target_ddl(cat, "DW").first()
    assert r.long_names == "points_second_background_picture" and not r.ok
    assert r.ddl == ('create table DW.t_points_account ( "id" number(24,0),'
                     '"points_second_background_picture" varchar2(1000),"create_time" timestamp )')
    renamed = target_ddl(cat, "DW", renames={"t_points_account": {"points_second_background_picture": "bg_pic",
                                                                  "id": "pid"}},
                         table_names={"t_points_account": "points_dw"}).first()
    assert renamed.ok and renamed.long_names is None
    assert renamed.ddl.startswith('create table DW.points_dw ( "pid" number(24,0),"bg_pic"')
    # exact-name rename: a column merely containing 'id' is untouched
    cat2 = catalog_frame(spark, [("t", 1, "id", "int"), ("t", 2, "user_id", "int")])
    assert '"user_id"' in target_ddl(cat2, renames={"t": {"id": "key"}}).first().ddl


def test_unsupported_column_blocks_ddl(spark):
    cat = catalog_frame(spark, [("t", 1, "id", "int"), ("t", 2, "j", "json")])
    r = target_ddl(cat).first()
    assert r.ddl is None and r.n_unsupported == 1 and not r.ok


def test_profile_catalog(spark):
    df = spark.createDataFrame([(1, "ab", 2.5, True), (2, "x" * 5000, None, None)],
                               "id bigint, s string, d double, b boolean")
    got = [(r.ordinal, r.field, r.src_type) for r in profile_catalog({"t": df}).orderBy("ordinal").collect()]
    assert got == [(1, "id", "bigint"), (2, "s", "text"), (3, "d", "double"), (4, "b", "bit(1)")]
    empty = spark.createDataFrame([], "s string")
    assert profile_catalog({"e": empty}).first().src_type == "varchar(1)"

