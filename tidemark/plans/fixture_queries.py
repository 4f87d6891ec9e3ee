"""Operator checks on the generated tables: one Spark plan + one SQL oracle each.

Every query reads whole tables from ``sf_dir`` (or frames Spark derives from
them). The SQL next to each function computes the same result in DuckDB over
views with the same table names; column names match one to one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.lists import parse_json_map, split_list
from tidemark.operators import (
    ambiguous_target_rows,
    batch_plan,
    delete_by_keys,
    duplicate_keys,
    incremental_filter,
    incremental_join,
    matched_by_keys,
    merge_metrics,
    merge_upsert,
    page,
    rename_columns,
    row_counts,
    stage_swap,
    unique_check_many,
    zero_dates_to_null,
)
from tidemark.operators.keys import distinct_keys
from tidemark.sources.files import FIXTURE_TABLES, read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


# Scenario constants shared by the Spark plans and the SQL oracles.
ORDERS_WATERMARK = "2001-07-01"
LINEITEM_STAGE_WATERMARK = "2001-10-01"
RECENT_ORDERS_FROM = "2001-01-01"
EVENTS_WATERMARK = "2024-01-29"
PAGE_SIZE = 4000
PLAN_THRESHOLD = 5000
PLAN_BATCH = 1000

TABLE_KEYS = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey",
    "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
    "lineitem": "l_orderkey|l_linenumber", "events": "user_id", "documents": "doc_id",
    "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id", "labels": "doc_id",
    "conversations": "conv_id|turn",
}


# ---------------------------------------------------------------- scenarios
def orders_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental slice of orders since the watermark, with a changed status."""
    orders = _t(spark, sf_dir, "orders")
    return incremental_filter(orders, "o_orderdate", ORDERS_WATERMARK).withColumn("o_orderstatus", F.lit("X"))


def orders_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lake copy from the previous run: pending ('P') orders not loaded yet."""
    return _t(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P")


def lineitem_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")
    return incremental_filter(li, "l_shipdate", LINEITEM_STAGE_WATERMARK).withColumn("l_linestatus", F.lit("U"))


def lineitem_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") != "R")


_ORDERS_SRC_SQL = f"""
  SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '{ORDERS_WATERMARK}'"""
_ORDERS_TGT_SQL = "SELECT * FROM orders WHERE o_orderstatus <> 'P'"
_LI_STAGE_SQL = f"""
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, 'U' AS l_linestatus, l_shipdate
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '{LINEITEM_STAGE_WATERMARK}'"""
_LI_TGT_SQL = "SELECT * FROM lineitem WHERE l_returnflag <> 'R'"


# ---------------------------------------------------------------- F4 incremental
@register("incremental_orders", f"SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{ORDERS_WATERMARK}'")
def q_incremental_orders(spark, sf_dir):
    return incremental_filter(_t(spark, sf_dir, "orders"), "o_orderdate", ORDERS_WATERMARK)


def events_with_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events plus ``ts_epoch`` (s) and ``ts_ms`` (ms) since 1970, reading ``ts`` as UTC wall time."""
    ev = _t(spark, sf_dir, "events")
    epoch = (F.unix_date(F.to_date("ts")).cast("bigint") * 86400 + F.hour("ts") * 3600
             + F.minute("ts") * 60 + F.second("ts")).cast("bigint")
    millis = F.date_format("ts", "SSS").cast("bigint")
    return ev.select("event_id", "user_id", "event_type", epoch.alias("ts_epoch"),
                     (epoch * 1000 + millis).alias("ts_ms"))


@register("incremental_events_epoch", f"""
SELECT event_id, user_id, event_type, ts_epoch FROM (
  SELECT event_id, user_id, event_type, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS ts_epoch FROM events)
WHERE ts_epoch >= CAST(epoch(TIMESTAMP '{EVENTS_WATERMARK}') AS BIGINT)""")
def q_incremental_events_epoch(spark, sf_dir):
    ev = events_with_epoch(spark, sf_dir).drop("ts_ms")
    return incremental_filter(ev, "ts_epoch", EVENTS_WATERMARK, unit="s")


@register("incremental_events_epoch_ms", f"""
SELECT event_id, ts_ms FROM (SELECT event_id, epoch_us(ts) // 1000 AS ts_ms FROM events)
WHERE ts_ms >= CAST(epoch(TIMESTAMP '{EVENTS_WATERMARK}') AS BIGINT) * 1000""")
def q_incremental_events_epoch_ms(spark, sf_dir):
    ev = events_with_epoch(spark, sf_dir).select("event_id", "ts_ms")
    return incremental_filter(ev, "ts_ms", EVENTS_WATERMARK, unit="ms")


@register("incremental_multi_col", f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, o.o_orderdate, l.l_extendedprice
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_shipdate >= TIMESTAMP '{ORDERS_WATERMARK}' OR o.o_orderdate >= TIMESTAMP '{ORDERS_WATERMARK}'""")
def q_incremental_multi_col(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    od = rename_columns(_t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"),
                        {"o_orderkey": "l_orderkey"})
    j = incremental_join(li, od, "l_orderkey", "l_shipdate", "o_orderdate", ORDERS_WATERMARK)
    return j.select("l_orderkey", "l_linenumber", "l_shipdate", "o_orderdate", "l_extendedprice")


# ---------------------------------------------------------------- M1 / M4 merge
@register("merge_upsert_orders", f"""
WITH src AS ({_ORDERS_SRC_SQL}), tgt AS ({_ORDERS_TGT_SQL})
SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.o_orderkey = tgt.o_orderkey)
UNION ALL SELECT * FROM src""")
def q_merge_upsert_orders(spark, sf_dir):
    return merge_upsert(orders_target(spark, sf_dir), orders_source(spark, sf_dir), "o_orderkey")


@register("merge_metrics_orders", f"""
WITH src AS ({_ORDERS_SRC_SQL}), tgt AS ({_ORDERS_TGT_SQL}),
m AS (SELECT tgt.o_orderkey FROM tgt WHERE EXISTS (SELECT 1 FROM src WHERE src.o_orderkey = tgt.o_orderkey))
SELECT (SELECT COUNT(*) FROM m) AS rows_updated,
       (SELECT COUNT(*) FROM src WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.o_orderkey = src.o_orderkey))
         AS rows_inserted,
       (SELECT COUNT(*) FROM tgt) - (SELECT COUNT(*) FROM m) AS rows_untouched,
       (SELECT COUNT(*) FROM tgt) - (SELECT COUNT(*) FROM m) + (SELECT COUNT(*) FROM src) AS rows_after""")
def q_merge_metrics_orders(spark, sf_dir):
    return merge_metrics(orders_target(spark, sf_dir), orders_source(spark, sf_dir), "o_orderkey")


# ---------------------------------------------------------------- M2 / M3 / J3
@register("stage_swap_lineitem", f"""
WITH st AS ({_LI_STAGE_SQL}), tgt AS ({_LI_TGT_SQL})
SELECT * FROM tgt WHERE NOT EXISTS (
  SELECT 1 FROM st WHERE st.l_orderkey = tgt.l_orderkey AND st.l_linenumber = tgt.l_linenumber)
UNION ALL SELECT * FROM st""")
def q_stage_swap_lineitem(spark, sf_dir):
    return stage_swap(lineitem_target(spark, sf_dir), lineitem_stage(spark, sf_dir), "l_orderkey|l_linenumber")


@register("merge_ambiguous_keys", f"""
WITH st AS ({_LI_STAGE_SQL}), tgt AS ({_LI_TGT_SQL}),
d AS (SELECT l_orderkey, l_linenumber FROM st GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)
SELECT * FROM tgt WHERE EXISTS (
  SELECT 1 FROM d WHERE d.l_orderkey = tgt.l_orderkey AND d.l_linenumber = tgt.l_linenumber)""")
def q_merge_ambiguous_keys(spark, sf_dir):
    return ambiguous_target_rows(lineitem_target(spark, sf_dir), lineitem_stage(spark, sf_dir),
                                 "l_orderkey|l_linenumber")


def recent_order_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = _t(spark, sf_dir, "orders")
    return incremental_filter(od, "o_orderdate", RECENT_ORDERS_FROM).select(F.col("o_custkey").alias("c_custkey"))


@register("delete_by_keys_customer", f"""
SELECT * FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_orderdate >= TIMESTAMP '{RECENT_ORDERS_FROM}' AND o.o_custkey = c.c_custkey)""")
def q_delete_by_keys_customer(spark, sf_dir):
    return delete_by_keys(_t(spark, sf_dir, "customer"), recent_order_customers(spark, sf_dir), "c_custkey",
                          keys_as_decimal=True)


@register("matched_by_keys_customer", f"""
SELECT * FROM customer c WHERE EXISTS (
  SELECT 1 FROM orders o WHERE o.o_orderdate >= TIMESTAMP '{RECENT_ORDERS_FROM}' AND o.o_custkey = c.c_custkey)""")
def q_matched_by_keys_customer(spark, sf_dir):
    return matched_by_keys(_t(spark, sf_dir, "customer"), recent_order_customers(spark, sf_dir), "c_custkey")


# ---------------------------------------------------------------- A1 / A2 / P5
def _unique_sql(table: str, keys: str) -> str:
    ks = keys.split("|")
    null_test = " OR ".join(f"{k} IS NULL" for k in ks)
    return f"""
SELECT '{table}' AS table_name, '{keys}' AS key_cols, n_rows, n_keys, n_dup_keys, n_null_key_rows,
       (n_dup_keys = 0 AND n_null_key_rows = 0) AS is_unique,
       CASE WHEN n_dup_keys = 0 AND n_null_key_rows = 0 THEN 'Unique' ELSE 'Not Unique' END AS comment
FROM (SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n_rows, CAST(COUNT(*) AS BIGINT) AS n_keys,
             CAST(COALESCE(SUM(CASE WHEN n > 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_dup_keys,
             CAST(COALESCE(SUM(CASE WHEN nul THEN n ELSE 0 END), 0) AS BIGINT) AS n_null_key_rows
      FROM (SELECT COUNT(*) AS n, ({null_test}) AS nul FROM {table} GROUP BY {', '.join(ks)}) g) r"""


@register("unique_check_all", "\nUNION ALL\n".join(_unique_sql(t, k) for t, k in TABLE_KEYS.items()))
def q_unique_check_all(spark, sf_dir):
    return unique_check_many({t: (_t(spark, sf_dir, t), k) for t, k in TABLE_KEYS.items()})


from tidemark.operators.bitmaps import compact_unique_check  # noqa: E402


@register("unique_bitmap_all", "\nUNION ALL\n".join(_unique_sql(t, k) for t, k in TABLE_KEYS.items()))
def q_unique_bitmap_all(spark, sf_dir):
    """The same report by bitmaps and hashes: no key that proves unique is shuffled."""
    return compact_unique_check({t: (_t(spark, sf_dir, t), k) for t, k in TABLE_KEYS.items()})


@register("duplicate_keys_lineitem", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def q_duplicate_keys_lineitem(spark, sf_dir):
    return duplicate_keys(_t(spark, sf_dir, "lineitem"), "l_orderkey|l_linenumber")


@register("distinct_keys_lineitem", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def q_distinct_keys_lineitem(spark, sf_dir):
    return distinct_keys(_t(spark, sf_dir, "lineitem"), "l_orderkey|l_linenumber")


@register("row_counts_all", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in FIXTURE_TABLES))
def q_row_counts_all(spark, sf_dir):
    return row_counts({t: _t(spark, sf_dir, t) for t in FIXTURE_TABLES})


@register("batch_plan_all", f"""
SELECT table_name, n_rows, n_rows > {PLAN_THRESHOLD} AS is_huge,
       CAST(CASE WHEN n_rows > {PLAN_THRESHOLD} THEN ceil(n_rows / {PLAN_BATCH}.0) ELSE 0 END AS BIGINT) AS n_batches
FROM ({" UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in FIXTURE_TABLES)})""")
def q_batch_plan_all(spark, sf_dir):
    return batch_plan(row_counts({t: _t(spark, sf_dir, t) for t in FIXTURE_TABLES}), PLAN_THRESHOLD, PLAN_BATCH)


# ---------------------------------------------------------------- P6 paging
@register("page_orders", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS row_index,
       CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // {PAGE_SIZE} AS BIGINT) AS batch_id
FROM orders""")
def q_page_orders(spark, sf_dir):
    # rows_per_bucket well below the table size so several range buckets are exercised.
    return page(_t(spark, sf_dir, "orders"), "o_orderkey", PAGE_SIZE, rows_per_bucket=1000)


@register("page_sizes_lineitem", f"""
SELECT batch_id, COUNT(*) AS n_rows, MIN(l_orderkey) AS first_key, MAX(l_orderkey) AS last_key FROM (
  SELECT l_orderkey, (row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1) // 25000 AS batch_id
  FROM lineitem) GROUP BY batch_id""")
def q_page_sizes_lineitem(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    # lineitem has no unique single key: page on a composite order (orderkey, linenumber).
    keyed = li.withColumn("_k", F.col("l_orderkey") * 1000 + F.col("l_linenumber"))
    p = page(keyed, "_k", 25000, rows_per_bucket=7000)
    return p.groupBy(F.col("batch_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("l_orderkey").alias("first_key"),
        F.max("l_orderkey").alias("last_key"))


# ---------------------------------------------------------------- P3 / S4 / X1 / X2
RENAME_MAP = '{"c_name": "c_mktsegment", "c_mktsegment": "c_name", "c_acctbal": "c_balance", "no_such": "x"}'


@register("rename_swap_customer", """
SELECT c_custkey, c_name AS c_mktsegment, c_nationkey, c_acctbal AS c_balance, c_mktsegment AS c_name
FROM customer""")
def q_rename_swap_customer(spark, sf_dir):
    return rename_columns(_t(spark, sf_dir, "customer"), RENAME_MAP)


@register("zero_dates_orders", """
SELECT o_orderkey, o_orderpriority,
       CASE WHEN d LIKE '0000-00-00%' THEN NULL ELSE strptime(d, '%Y-%m-%d %H:%M:%S') END AS o_orderdate
FROM (SELECT o_orderkey, o_orderpriority,
             CASE WHEN o_orderpriority = '5-LOW' THEN '0000-00-00 00:00:00'
                  ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS d FROM orders)""")
def q_zero_dates_orders(spark, sf_dir):
    od = _t(spark, sf_dir, "orders")
    text = od.select(
        "o_orderkey", "o_orderpriority",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("0000-00-00 00:00:00"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("o_orderdate"))
    return zero_dates_to_null(text, "o_orderdate")


@register("mapping_json_events", """
SELECT event_id, json_extract_string(props, '$.k') AS prop_k,
       CAST(len(parts) AS INTEGER) AS n_parts, parts[1] AS first_part, parts[len(parts)] AS last_part
FROM (SELECT event_id, props,
             list_filter(list_transform(string_split(event_type || '|' || CAST(user_id AS VARCHAR) || '||', '|'),
                                        lambda x: trim(x)), lambda x: x <> '') AS parts FROM events)""")
def q_mapping_json_events(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    listed = ev.select("event_id", parse_json_map("props").alias("_m"), split_list(
        F.concat_ws("|", "event_type", F.col("user_id").cast("string"), F.lit(""), F.lit(""))).alias("_p"))
    return listed.select(
        "event_id", F.col("_m")["k"].alias("prop_k"),
        F.size("_p").alias("n_parts"), F.element_at("_p", 1).alias("first_part"),
        F.element_at("_p", -1).alias("last_part"))


# ---------------------------------------------------------------- L1 one page / F4 on ISO text
from tidemark.operators import page_slice  # noqa: E402

PAGE_NO = 2


@register("page_slice_orders", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS row_index,
       CAST({PAGE_NO} AS BIGINT) AS batch_id
FROM orders ORDER BY o_orderkey LIMIT {PAGE_SIZE} OFFSET {PAGE_NO * PAGE_SIZE}""")
def q_page_slice_orders(spark, sf_dir):
    return page_slice(_t(spark, sf_dir, "orders"), "o_orderkey", PAGE_SIZE, PAGE_NO, rows_per_bucket=1000)


@register("incremental_orders_text", f"""
SELECT o_orderkey, o_orderdate_text FROM (
  SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate_text FROM orders)
WHERE o_orderdate_text >= '{ORDERS_WATERMARK}'""")
def q_incremental_orders_text(spark, sf_dir):
    text = _t(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate_text"))
    return incremental_filter(text, "o_orderdate_text", ORDERS_WATERMARK)


# ---------------------------------------------------------------- exact pages of large and wide keys
BIG_KEY = 2 ** 60
WIDE_KEY = 10 ** 20


@register("page_bigkeys_orders", f"""
SELECT o_orderkey + {BIG_KEY} AS big_key, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS row_index,
       CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // {PAGE_SIZE} AS BIGINT) AS batch_id FROM orders""")
def q_page_bigkeys_orders(spark, sf_dir):
    """Keys above 2^53, which doubles can't tell apart."""
    big = _t(spark, sf_dir, "orders").select((F.col("o_orderkey") + F.lit(BIG_KEY)).alias("big_key"))
    return page(big, "big_key", PAGE_SIZE, rows_per_bucket=300)


@register("page_decimal_orders", f"""
SELECT CAST(CAST('{WIDE_KEY}' AS DECIMAL(38,0)) + o_orderkey AS VARCHAR) AS wide_key,
       CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS row_index,
       CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // {PAGE_SIZE} AS BIGINT) AS batch_id FROM orders""")
def q_page_decimal_orders(spark, sf_dir):
    wide = _t(spark, sf_dir, "orders").select(
        (F.lit(str(WIDE_KEY)).cast("decimal(38,0)") + F.col("o_orderkey")).cast("decimal(38,0)").alias("wide_key"))
    return page(wide, "wide_key", PAGE_SIZE, rows_per_bucket=1000).withColumn("wide_key", F.col("wide_key").cast("string"))


# ---------------------------------------------------------------- X8 fractional keys
@register("delete_decimal_keys_orders", """
SELECT o_orderkey, k FROM (SELECT o_orderkey, o_orderkey || '.' || (o_orderkey % 4) AS k FROM orders)
WHERE CAST(k AS DECIMAL(38,10)) NOT IN (SELECT CAST(o_orderkey || '.' || '2' AS DECIMAL(38,10)) FROM orders)""")
def q_delete_decimal_keys_orders(spark, sf_dir):
    """Keys compared as numbers: n.2 goes, n.0, n.1 and n.3 stay."""
    od = _t(spark, sf_dir, "orders")
    target = od.select("o_orderkey", F.concat(F.col("o_orderkey"), F.lit("."), F.col("o_orderkey") % 4).alias("k"))
    gone = od.select(F.concat(F.col("o_orderkey"), F.lit(".20")).alias("k"))
    return delete_by_keys(target, gone, "k", keys_as_decimal=True)
