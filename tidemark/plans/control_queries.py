"""Control-plane checks at table scale.

The control tables are derived from the generated tables so their size grows
with the data: one config row per customer (its source "table"), one
connection per nation (its source "database").

* timecols     — by market segment: none / one / two (with a trailing '|')
* primarykeys  — one or two keys
* watermark    — date of the customer's last order; NULL for one segment
                 (never loaded); some fall on the run date (→ skip / not pending)
                 and some after it
* mappings     — NULL, a valid JSON object, or broken JSON (→ task FAILED)
* status       — '0' for the richest accounts (disabled)
* connections  — every nation twice (removed by distinct), region 3 has no
                 connection, region 4 has a NULL password
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.fixture_queries import _t, register
from tidemark.plans.schedule import (
    FAILED,
    SUCCESS,
    apply_run_results,
    build_schedule,
    parse_tasks,
    with_load_mode,
)

RUN_DATE = "2001-07-31"
GOOD_MAPPING = '{"c_name": "name", "c_phone": "phone"}'
BAD_MAPPING = '{"id": '


def derived_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = _t(spark, sf_dir, "customer")
    last = _t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_order"))
    j = cust.join(last, cust["c_custkey"] == last["o_custkey"], "left")
    seg, bal = F.col("c_mktsegment"), F.col("c_acctbal")
    return j.select(
        F.concat(F.lit("t_cust_"), F.col("c_custkey").cast("string")).alias("tablename"),
        F.concat(F.lit("db_"), F.col("c_nationkey").cast("string")).alias("dbname"),
        F.concat(F.lit("src"), F.col("c_nationkey").cast("string"), F.lit(":3306")).alias("host_port"),
        F.when(seg == "AUTOMOBILE", F.lit(None).cast("string"))
        .when(seg == "BUILDING", F.lit("create_time"))
        .otherwise(F.lit("create_time|mod_time|")).alias("timecols"),
        F.when(seg == "MACHINERY", F.lit("id|shop_id")).otherwise(F.lit("id")).alias("primarykeys"),
        F.concat(F.lit("dw_cust_"), F.col("c_custkey").cast("string")).alias("targettable"),
        F.when(seg == "HOUSEHOLD", F.lit(None).cast("string"))
        .otherwise(F.date_format("last_order", "yyyy-MM-dd")).alias("watermark"),
        F.lit("8.0").alias("dbversion"),
        F.when(bal < 0, F.lit(BAD_MAPPING)).when(bal < 5000, F.lit(None).cast("string"))
        .otherwise(F.lit(GOOD_MAPPING)).alias("mappings"),
        F.when(bal > 9000, F.lit("0")).otherwise(F.lit("1")).alias("status"),
        F.lit(None).cast("string").alias("comments"),
    )


def derived_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    nat = _t(spark, sf_dir, "nation")
    rows = nat.unionByName(nat).filter(F.col("n_regionkey") != 3)
    return rows.select(
        F.concat(F.lit("db_"), F.col("n_nationkey").cast("string")).alias("db_name"),
        F.lit("ignored").alias("host_port"),
        F.lower("n_name").alias("username"),
        F.when(F.col("n_regionkey") == 4, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("pw_"), F.col("n_nationkey").cast("string"))).alias("passwd"),
    )


_CONTROL_SQL = f"""
last AS (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey),
cfg AS (
  SELECT 't_cust_' || CAST(c_custkey AS VARCHAR) AS tablename,
         'db_' || CAST(c_nationkey AS VARCHAR) AS dbname,
         'src' || CAST(c_nationkey AS VARCHAR) || ':3306' AS host_port,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 'create_time'
              ELSE 'create_time|mod_time|' END AS timecols,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'id|shop_id' ELSE 'id' END AS primarykeys,
         'dw_cust_' || CAST(c_custkey AS VARCHAR) AS targettable,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE strftime(last_order, '%Y-%m-%d') END AS watermark,
         '8.0' AS dbversion,
         CASE WHEN c_acctbal < 0 THEN '{BAD_MAPPING}' WHEN c_acctbal < 5000 THEN NULL
              ELSE '{GOOD_MAPPING}' END AS mappings,
         CASE WHEN c_acctbal > 9000 THEN '0' ELSE '1' END AS status,
         CAST(NULL AS VARCHAR) AS comments
  FROM customer LEFT JOIN last ON c_custkey = o_custkey),
conns AS (
  SELECT 'db_' || CAST(n_nationkey AS VARCHAR) AS db_name, 'ignored' AS host_port, lower(n_name) AS username,
         CASE WHEN n_regionkey = 4 THEN NULL ELSE 'pw_' || CAST(n_nationkey AS VARCHAR) END AS passwd
  FROM (SELECT * FROM nation UNION ALL SELECT * FROM nation) WHERE n_regionkey <> 3),
sched AS (
  SELECT DISTINCT p.tablename, p.dbname, p.host_port, p.timecols, p.primarykeys, p.targettable, p.watermark,
         c.username, c.passwd, p.dbversion, p.mappings
  FROM (SELECT * FROM cfg WHERE watermark <> '{RUN_DATE}' OR watermark IS NULL) p
  LEFT JOIN (SELECT DISTINCT db_name, username, passwd FROM conns) c ON p.dbname = c.db_name
  WHERE p.status = '1' AND c.passwd IS NOT NULL),
parsed AS (
  SELECT *, CASE WHEN len(tl) = 0 THEN NULL ELSE tl END AS time_cols,
         CASE WHEN len(kl) = 0 THEN NULL ELSE kl END AS primary_keys,
         (mappings IS NOT NULL AND trim(mappings) <> '' AND NOT json_valid(mappings)) AS mapping_error
  FROM (SELECT *,
          list_filter(list_transform(string_split(timecols, '|'), lambda x: trim(x)), lambda x: x <> '') AS tl,
          list_filter(list_transform(string_split(primarykeys, '|'), lambda x: trim(x)), lambda x: x <> '') AS kl
        FROM sched)),
modes AS (
  SELECT *, CASE WHEN watermark IS NULL OR time_cols IS NULL THEN 'full'
                 WHEN watermark = '{RUN_DATE}' THEN 'skip' ELSE 'incremental' END AS load_mode
  FROM parsed)"""


@register("schedule_customer", f"""
WITH {_CONTROL_SQL}
SELECT * FROM sched""")
def q_schedule_customer(spark, sf_dir):
    return build_schedule(derived_config(spark, sf_dir), derived_connections(spark, sf_dir), RUN_DATE)


def _load_modes(spark, sf_dir):
    sched = build_schedule(derived_config(spark, sf_dir), derived_connections(spark, sf_dir), RUN_DATE)
    return with_load_mode(parse_tasks(sched), RUN_DATE)


def _n(arr):
    return F.when(arr.isNull(), F.lit(None)).otherwise(F.size(arr))


@register("load_modes_customer", f"""
WITH {_CONTROL_SQL}
SELECT tablename, targettable, 'jdbc:mysql://' || host_port AS url,
       CAST(len(time_cols) AS INTEGER) AS n_time_cols, CAST(len(primary_keys) AS INTEGER) AS n_keys,
       time_cols[len(time_cols)] AS last_time_col, primary_keys[1] AS first_key,
       mapping_error,
       CASE WHEN mappings IS NOT NULL AND json_valid(mappings) THEN json_extract_string(mappings, '$.c_name')
       END AS c_name_renamed,
       (time_cols IS NOT NULL AND watermark IS NOT NULL) AS is_incremental, load_mode,
       CASE WHEN load_mode = 'full' THEN 'overwrite' ELSE 'append' END AS write_mode
FROM modes""")
def q_load_modes_customer(spark, sf_dir):
    lm = _load_modes(spark, sf_dir)
    return lm.select(
        "tablename", "targettable", "url",
        _n(F.col("time_cols")).alias("n_time_cols"), _n(F.col("primary_keys")).alias("n_keys"),
        F.element_at("time_cols", -1).alias("last_time_col"), F.element_at("primary_keys", 1).alias("first_key"),
        "mapping_error", F.col("mapping")["c_name"].alias("c_name_renamed"),
        "is_incremental", "load_mode", "write_mode")


@register("run_results_customer", f"""
WITH {_CONTROL_SQL},
res AS (SELECT targettable, CASE WHEN mapping_error THEN 'FAILED' ELSE 'SUCCESS' END AS status
        FROM modes WHERE load_mode <> 'skip'),
r AS (SELECT targettable AS rkey,
             CASE WHEN max(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) = 1 THEN 'FAILED' ELSE 'SUCCESS' END AS st
      FROM res GROUP BY targettable)
SELECT cfg.tablename, cfg.dbname, cfg.host_port, cfg.timecols, cfg.primarykeys, cfg.targettable,
       CASE WHEN r.st = 'SUCCESS' THEN '{RUN_DATE}' ELSE cfg.watermark END AS watermark,
       cfg.dbversion, cfg.mappings, cfg.status, coalesce(r.st, cfg.comments) AS comments
FROM cfg LEFT JOIN r ON cfg.targettable = r.rkey""")
def q_run_results_customer(spark, sf_dir):
    lm = _load_modes(spark, sf_dir).filter(F.col("load_mode") != "skip")
    results = lm.select("targettable", F.when(F.col("mapping_error"), F.lit(FAILED))
                        .otherwise(F.lit(SUCCESS)).alias("status"))
    return apply_run_results(derived_config(spark, sf_dir), results, RUN_DATE)


from tidemark.plans.journal import append_rows, current_config, read_journal  # noqa: E402
from tidemark.session import shared_dir  # noqa: E402


@register("run_journal_customer", f"""
WITH {_CONTROL_SQL},
tried AS (SELECT targettable, NOT mapping_error AS good, CAST(substr(targettable, 9) AS BIGINT) AS k FROM modes WHERE load_mode <> 'skip'),
r AS (SELECT targettable AS rkey, CASE WHEN good OR k % 3 = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS st FROM tried)
SELECT cfg.tablename, cfg.dbname, cfg.host_port, cfg.timecols, cfg.primarykeys, cfg.targettable,
       CASE WHEN r.st = 'SUCCESS' THEN greatest(cfg.watermark, '{RUN_DATE}') ELSE cfg.watermark END AS watermark,
       cfg.dbversion, cfg.mappings, cfg.status, coalesce(r.st, cfg.comments) AS comments
FROM cfg LEFT JOIN r ON cfg.targettable = r.rkey""")
def q_run_journal_customer(spark, sf_dir):
    """A run that is lost halfway and started again: the second start finds what the journal has and does the rest.

    In the second one every third of the tables that failed before succeeds."""
    path, stored = shared_dir(spark, "journal"), derived_config(spark, sf_dir)
    number = F.substring_index("targettable", "_", -1).cast("long")
    mended = F.lit(False)
    for start, reached in enumerate((number % 2 == 0, F.lit(True))):
        config = current_config(stored, read_journal(spark, path))
        due = with_load_mode(build_schedule(config, derived_connections(spark, sf_dir), RUN_DATE), RUN_DATE).where("load_mode <> 'skip'")
        good = ~F.col("mapping_error") | mended
        rows = due.where(reached).select(
            F.lit(RUN_DATE).alias("run_date"), F.lit(start).cast("long").alias("at"), "dbname", "tablename", "targettable", "load_mode",
            F.when(good, F.lit(SUCCESS)).otherwise(F.lit(FAILED)).alias("status"), F.lit(None).cast("string").alias("error"),
            F.lit(1.0).alias("seconds"), F.lit(1).alias("of_target"))
        append_rows(rows, path)
        mended = number % 3 == 0
    return current_config(stored, read_journal(spark, path))


# ---------------------------------------------------------------- type mapping / DDL
from tidemark.functions.typemap import map_types  # noqa: E402
from tidemark.plans.ddl import target_ddl  # noqa: E402
from tidemark.sources.catalog import profile_catalog  # noqa: E402
from tidemark.sources.files import FIXTURE_TABLES  # noqa: E402

# Column kinds of the generated tables, used only to write the SQL oracle:
# 's' text (width from data), 'i:<type>' integer of that declared type, else a fixed source type.
FIXTURE_SCHEMAS = {
    "region": [("r_regionkey", "i:int"), ("r_name", "s")],
    "nation": [("n_nationkey", "i:int"), ("n_name", "s"), ("n_regionkey", "i:int")],
    "customer": [("c_custkey", "i:bigint"), ("c_name", "s"), ("c_nationkey", "i:int"), ("c_acctbal", "double"),
                 ("c_mktsegment", "s")],
    "supplier": [("s_suppkey", "i:bigint"), ("s_name", "s"), ("s_nationkey", "i:int"), ("s_acctbal", "double")],
    "part": [("p_partkey", "i:bigint"), ("p_name", "s"), ("p_brand", "s"), ("p_type", "s"), ("p_size", "i:int"),
             ("p_retailprice", "double")],
    "orders": [("o_orderkey", "i:bigint"), ("o_custkey", "i:bigint"), ("o_orderstatus", "s"),
               ("o_totalprice", "double"), ("o_orderdate", "datetime"), ("o_orderpriority", "s")],
    "lineitem": [("l_orderkey", "i:bigint"), ("l_partkey", "i:bigint"), ("l_suppkey", "i:bigint"),
                 ("l_linenumber", "i:int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                 ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "s"), ("l_linestatus", "s"),
                 ("l_shipdate", "datetime")],
    "events": [("event_id", "i:bigint"), ("ts", "datetime"), ("user_id", "i:bigint"), ("event_type", "s"),
               ("value", "double"), ("props", "s")],
    "documents": [("doc_id", "i:bigint"), ("text", "s"), ("lang", "s"), ("source", "s"), ("n_chars", "i:bigint")],
    "embeddings": [("vec_id", "i:bigint"), ("embedding", "json"), ("label", "i:int")],
    "pages": [("page_id", "i:bigint"), ("url", "s"), ("html", "s")],
    "benchmark": [("item_id", "i:bigint"), ("text", "s")],
    "labels": [("doc_id", "i:bigint"), ("quality", "i:int"), ("toxic", "i:int")],
    "conversations": [("conv_id", "i:bigint"), ("turn", "i:bigint"), ("role", "s"), ("text", "s")],
}
DDL_SCHEMA = "DW"


def _sql_src_type(kind: str, i: int) -> str:
    if kind == "s":
        n = f"coalesce(_len{i}, 0)"
        parts = [f"WHEN {n} <= 4000 THEN 'varchar(' || CAST(greatest({n}, 1) AS VARCHAR) || ')'",
                 f"WHEN {n} <= 65535 THEN 'text'", f"WHEN {n} <= 16777215 THEN 'mediumtext'"]
        return "CASE " + " ".join(parts) + " ELSE 'longtext' END"
    if kind.startswith("i:"):
        return f"'{kind[2:]}'"
    return f"'{kind}'"


def _sql_catalog() -> str:
    ctes, selects = [], []
    for t in FIXTURE_TABLES:
        aggs = ["COUNT(*) AS _rows"]
        for i, (c, kind) in enumerate(FIXTURE_SCHEMAS[t], 1):
            if kind == "s":
                aggs.append(f"max(octet_length(encode({c}))) AS _len{i}")
            selects.append(f"SELECT '{t}' AS table_name, {i} AS ordinal, '{c}' AS field, "
                           f"{_sql_src_type(kind, i)} AS src_type FROM a_{t}")
        ctes.append(f"a_{t} AS (SELECT {', '.join(aggs)} FROM {t})")
    return ",\n".join(ctes) + ",\ncatalog AS (\n" + "\nUNION ALL\n".join(selects) + ")"


def _sql_parts(src: str) -> tuple[str, str, str]:
    t = f"trim(regexp_replace(lower(trim({src})), '\\s+unsigned\\b', '', 'g'))"
    base = f"regexp_extract({t}, '^([a-z0-9_]+)', 1)"
    args = f"regexp_replace(regexp_extract({t}, '^[a-z0-9_]+\\s*\\(([^)]*)\\)', 1), '\\s+', '', 'g')"
    return t, base, args


def _sql_tgt_type(src: str) -> str:
    """The mapping written out on its own: the SQL shares no table with the code it checks."""
    t, base, args = _sql_parts(src)
    return (f"CASE WHEN {base} = 'varchar' THEN 'varchar2(1000)' WHEN {base} = 'tinyint' THEN 'number(5,0)' "
            f"WHEN {base} = 'smallint' THEN 'number(7,0)' WHEN {base} = 'mediumint' THEN 'number(9,0)' "
            f"WHEN {base} = 'bigint' THEN 'number(24,0)' WHEN {base} = 'int' THEN 'number(12,0)' "
            f"WHEN {base} IN ('text', 'mediumtext', 'longtext') THEN 'clob' WHEN {base} = 'long' THEN 'varchar2(4000)' "
            f"WHEN {base} IN ('double', 'float', 'decimal') AND {args} <> '' THEN 'number(' || {args} || ')' "
            f"WHEN {base} IN ('double', 'float', 'decimal') THEN 'number' "
            f"WHEN {base} = 'datetime' AND {args} <> '' THEN 'timestamp(' || {args} || ')' "
            f"WHEN {base} IN ('datetime', 'timestamp') THEN 'timestamp' "
            f"WHEN {base} = 'bit' AND {args} = '1' THEN 'number(2,0)' "
            f"WHEN {base} IN ('date', 'char', 'blob') THEN {t} ELSE NULL END")


def _sql_map_status(src: str) -> str:
    t, base, args = _sql_parts(src)
    return (f"CASE WHEN ({_sql_tgt_type(src)}) IS NULL THEN 'unsupported' "
            f"WHEN {base} = 'varchar' AND regexp_full_match({args}, '[0-9]+') "
            f"AND CAST({args} AS BIGINT) > 1000 THEN 'narrowed' ELSE 'ok' END")


_MAPPED_SQL = (f"mapped AS (SELECT table_name, ordinal, field, src_type, {_sql_tgt_type('src_type')} AS tgt_type, "
               f"{_sql_map_status('src_type')} AS map_status FROM catalog)")


def fixture_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_catalog({t: _t(spark, sf_dir, t) for t in FIXTURE_TABLES})


@register("type_map_all", f"""
WITH {_sql_catalog()},
{_MAPPED_SQL}
SELECT * FROM mapped""")
def q_type_map_all(spark, sf_dir):
    return map_types(fixture_catalog(spark, sf_dir))


#: Every kind of source type, with the mapping expected of it (None: no mapping).
RULE_CASES = [
    ("varchar(255)", "varchar2(1000)", "ok"), ("varchar(1001)", "varchar2(1000)", "narrowed"), ("VARCHAR ( 20 )", "varchar2(1000)", "ok"),
    ("tinyint(4)", "number(5,0)", "ok"), ("tinyint(3) unsigned", "number(5,0)", "ok"), ("smallint(6)", "number(7,0)", "ok"),
    ("mediumint(9)", "number(9,0)", "ok"), ("int(11)", "number(12,0)", "ok"), ("int(10) unsigned", "number(12,0)", "ok"),
    ("bigint(20)", "number(24,0)", "ok"), ("double", "number", "ok"), ("double(10,2)", "number(10,2)", "ok"), ("float", "number", "ok"),
    ("decimal(11, 2)", "number(11,2)", "ok"), ("decimal(10,2) unsigned", "number(10,2)", "ok"), ("datetime", "timestamp", "ok"),
    ("datetime(3)", "timestamp(3)", "ok"), ("timestamp", "timestamp", "ok"), ("timestamp(6)", "timestamp", "ok"),
    ("bit(1)", "number(2,0)", "ok"), ("bit(8)", None, "unsupported"), ("text", "clob", "ok"), ("mediumtext", "clob", "ok"),
    ("longtext", "clob", "ok"), ("long", "varchar2(4000)", "ok"), ("date", "date", "ok"), ("char(2)", "char(2)", "ok"),
    ("blob", "blob", "ok"), ("enum('a','b')", None, "unsupported"), ("json", None, "unsupported"), ("geometry", None, "unsupported"),
]


def _lit(x: str | None) -> str:
    return "NULL" if x is None else "'" + x.replace("'", "''") + "'"


@register("type_map_rules", f"""
WITH cases AS (SELECT * FROM (VALUES {", ".join(f"({i}, {_lit(a)}, {_lit(b)}, {_lit(c)})" for i, (a, b, c) in enumerate(RULE_CASES))})
  v(i, src_type, tgt_type, map_status))
SELECT p_name AS field, c.src_type, c.tgt_type, c.map_status FROM part JOIN cases c ON p_partkey % {len(RULE_CASES)} = c.i""")
def q_type_map_rules(spark, sf_dir):
    """Each part is a column of one of the source types; the SQL holds the expected types as literals."""
    types = F.array(*[F.lit(a) for a, _, _ in RULE_CASES])
    cat = _t(spark, sf_dir, "part").select(
        F.lit("part").alias("table_name"), F.col("p_partkey").cast("int").alias("ordinal"), F.col("p_name").alias("field"),
        F.get(types, (F.col("p_partkey") % len(RULE_CASES)).cast("int")).alias("src_type"))
    return map_types(cat).select("field", "src_type", "tgt_type", "map_status")


@register("target_ddl_all", f"""
WITH {_sql_catalog()},
{_MAPPED_SQL}
SELECT table_name,
       CASE WHEN sum(CASE WHEN map_status = 'unsupported' THEN 1 ELSE 0 END) = 0 THEN
         'create table {DDL_SCHEMA}.' || table_name || ' ( ' ||
         string_agg('"' || field || '" ' || tgt_type, ',' ORDER BY ordinal) || ' )' END AS ddl,
       CAST(COUNT(*) AS BIGINT) AS n_columns,
       CAST(sum(CASE WHEN map_status = 'unsupported' THEN 1 ELSE 0 END) AS BIGINT) AS n_unsupported,
       CAST(sum(CASE WHEN map_status = 'narrowed' THEN 1 ELSE 0 END) AS BIGINT) AS n_narrowed,
       string_agg(CASE WHEN length(field) > 30 THEN field END, '|' ORDER BY field) AS long_names,
       (sum(CASE WHEN map_status <> 'ok' THEN 1 ELSE 0 END) = 0
        AND count(CASE WHEN length(field) > 30 THEN 1 END) = 0) AS ok
FROM mapped GROUP BY table_name""")
def q_target_ddl_all(spark, sf_dir):
    return target_ddl(fixture_catalog(spark, sf_dir), DDL_SCHEMA)


# ---------------------------------------------------------------- uniqueness verdicts into the config
from tidemark.operators import unique_check_many  # noqa: E402
from tidemark.plans.fixture_queries import TABLE_KEYS, _unique_sql  # noqa: E402
from tidemark.plans.schedule import apply_unique_results  # noqa: E402

FIXTURE_DB = "fixtures"


def fixture_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One config row per generated table."""
    named = spark.createDataFrame([(t, TABLE_KEYS[t]) for t in FIXTURE_TABLES], "table_name string, keys string")
    keys = F.col("keys")
    return named.select(
        F.col("table_name").alias("tablename"), F.lit(FIXTURE_DB).alias("dbname"),
        F.lit("local").alias("host_port"), F.lit(None).cast("string").alias("timecols"),
        keys.alias("primarykeys"), F.concat(F.lit("dw_"), F.col("table_name")).alias("targettable"),
        F.lit(None).cast("string").alias("watermark"), F.lit("8.0").alias("dbversion"),
        F.lit(None).cast("string").alias("mappings"), F.lit("1").alias("status"),
        F.lit(None).cast("string").alias("comments"))


_FIXTURE_CONFIG_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS tablename, '{FIXTURE_DB}' AS dbname, 'local' AS host_port, CAST(NULL AS VARCHAR) AS timecols, "
    f"'{TABLE_KEYS[t]}' AS primarykeys, 'dw_{t}' AS targettable, CAST(NULL AS VARCHAR) AS watermark, "
    f"'8.0' AS dbversion, CAST(NULL AS VARCHAR) AS mappings, '1' AS status, CAST(NULL AS VARCHAR) AS comments"
    for t in FIXTURE_TABLES)


@register("unique_comments_fixture", f"""
WITH cfg AS ({_FIXTURE_CONFIG_SQL}),
chk AS ({" UNION ALL ".join(_unique_sql(t, k) for t, k in TABLE_KEYS.items())})
SELECT cfg.tablename, cfg.dbname, cfg.host_port, cfg.timecols, cfg.primarykeys, cfg.targettable, cfg.watermark,
       cfg.dbversion, cfg.mappings, cfg.status, coalesce(chk.comment, cfg.comments) AS comments
FROM cfg LEFT JOIN chk ON cfg.dbname = '{FIXTURE_DB}' AND cfg.tablename = chk.table_name""")
def q_unique_comments_fixture(spark, sf_dir):
    cfg = fixture_config(spark, sf_dir)
    checks = unique_check_many({t: (_t(spark, sf_dir, t), k) for t, k in TABLE_KEYS.items()}).select(
        F.lit(FIXTURE_DB).alias("dbname"), F.col("table_name").alias("tablename"), "comment")
    return apply_unique_results(cfg, checks)


@register("load_modes_all_customer", f"""
WITH {_CONTROL_SQL},
allparsed AS (
  SELECT tablename, watermark,
         CASE WHEN len(tl) = 0 THEN NULL ELSE tl END AS time_cols
  FROM (SELECT *, list_filter(list_transform(string_split(timecols, '|'), lambda x: trim(x)),
                              lambda x: x <> '') AS tl FROM cfg))
SELECT tablename,
       CASE WHEN watermark IS NULL OR time_cols IS NULL THEN 'full'
            WHEN watermark = '{RUN_DATE}' THEN 'skip' ELSE 'incremental' END AS load_mode
FROM allparsed""")
def q_load_modes_all_customer(spark, sf_dir):
    """Load modes of the whole config (not only the pending rows): includes 'skip'."""
    return with_load_mode(parse_tasks(derived_config(spark, sf_dir)), RUN_DATE).select("tablename", "load_mode")


@register("unique_comments_two_targets", f"""
WITH cfg AS ({_FIXTURE_CONFIG_SQL}),
two AS (SELECT * FROM cfg UNION ALL SELECT * REPLACE (targettable || '_b' AS targettable) FROM cfg),
chk AS ({" UNION ALL ".join(_unique_sql(t, k) for t, k in TABLE_KEYS.items())})
SELECT two.tablename, two.dbname, two.host_port, two.timecols, two.primarykeys, two.targettable, two.watermark,
       two.dbversion, two.mappings, two.status, chk.comment AS comments
FROM two JOIN chk ON two.tablename = chk.table_name""")
def q_unique_comments_two_targets(spark, sf_dir):
    """One source table feeding two targets, checked for each: two config rows in, two out."""
    cfg = fixture_config(spark, sf_dir)
    both = cfg.unionByName(cfg.withColumn("targettable", F.concat("targettable", F.lit("_b"))))
    once = unique_check_many({t: (_t(spark, sf_dir, t), k) for t, k in TABLE_KEYS.items()}).select(
        F.lit(FIXTURE_DB).alias("dbname"), F.col("table_name").alias("tablename"), "comment")
    return apply_unique_results(both, once.unionByName(once))
