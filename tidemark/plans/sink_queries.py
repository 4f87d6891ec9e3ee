"""Sink round trips: keyed lake tables written, updated by key, and read back.

Each check writes under the session's shared checkpoint folder (a fresh
sub-folder per call) and returns the lake table read back; the expected rows
are the same as for the in-memory operator, so the SQL oracle is shared.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.fixture_queries import (
    REGISTRY,
    lineitem_stage,
    lineitem_target,
    orders_source,
    orders_target,
    register,
)
from tidemark.session import shared_dir
from tidemark.sinks.lake import overwrite_lake, read_lake, swap_lake, upsert_lake
from tidemark.streaming.upsert_stream import file_stream, upsert_stream

LAKE_BUCKETS = 64


@register("lake_upsert_orders", REGISTRY["merge_upsert_orders"][1])
def q_lake_upsert_orders(spark, sf_dir):
    path = shared_dir(spark, "lake") + "/orders"
    overwrite_lake(spark, orders_target(spark, sf_dir), path, keys="o_orderkey", n_buckets=LAKE_BUCKETS)
    upsert_lake(spark, orders_source(spark, sf_dir), path, "o_orderkey")
    return read_lake(spark, path)


@register("lake_swap_lineitem", REGISTRY["stage_swap_lineitem"][1])
def q_lake_swap_lineitem(spark, sf_dir):
    path = shared_dir(spark, "lake") + "/lineitem"
    keys = "l_orderkey|l_linenumber"
    overwrite_lake(spark, lineitem_target(spark, sf_dir), path, keys=keys, n_buckets=LAKE_BUCKETS)
    swap_lake(spark, lineitem_stage(spark, sf_dir), path, keys)
    return read_lake(spark, path)


@register("stream_upsert_orders", REGISTRY["merge_upsert_orders"][1])
def q_stream_upsert_orders(spark, sf_dir):
    base = shared_dir(spark, "stream")
    path, landing, ckpt = f"{base}/lake/orders", f"{base}/landing", f"{base}/checkpoint"
    overwrite_lake(spark, orders_target(spark, sf_dir), path, keys="o_orderkey", n_buckets=LAKE_BUCKETS)
    # The changed rows arrive as several files: one micro-batch each.
    src = orders_source(spark, sf_dir)
    src.repartition(4, F.col("o_orderdate")).write.mode("overwrite").parquet(landing)
    stream = file_stream(spark, landing, src.schema, max_files_per_trigger=1)
    q = upsert_stream(stream, path, "o_orderkey", ckpt, available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_lake(spark, path)


# ---------------------------------------------------------------- merge on read
from tidemark.sinks.lake import compact_lake  # noqa: E402


@register("lake_delta_orders", REGISTRY["merge_upsert_orders"][1])
def q_lake_delta_orders(spark, sf_dir):
    """Three slices as deltas (the first one outdated by the others), the worst buckets compacted in between."""
    path = shared_dir(spark, "lake") + "/orders"
    overwrite_lake(spark, orders_target(spark, sf_dir), path, keys="o_orderkey", n_buckets=LAKE_BUCKETS)
    src = orders_source(spark, sf_dir)
    upsert_lake(spark, src.withColumn("o_orderstatus", F.lit("W")), path, "o_orderkey", as_delta=True)
    upsert_lake(spark, src.where("o_orderkey % 2 = 0"), path, "o_orderkey")
    compact_lake(spark, path, most_buckets=LAKE_BUCKETS // 4)
    upsert_lake(spark, src.where("o_orderkey % 2 = 1"), path, "o_orderkey")
    return read_lake(spark, path)


from tidemark.sinks.lake import split_lake  # noqa: E402


@register("lake_split_orders", REGISTRY["merge_upsert_orders"][1])
def q_lake_split_orders(spark, sf_dir):
    """A table of four buckets that are split twice as slices arrive: before the first split, between the two, and after."""
    path = shared_dir(spark, "lake") + "/orders"
    target = orders_target(spark, sf_dir)
    overwrite_lake(spark, target, path, keys="o_orderkey", n_buckets=4)
    src, rows = orders_source(spark, sf_dir), target.count()
    upsert_lake(spark, src.withColumn("o_orderstatus", F.lit("W")), path, "o_orderkey")
    split_lake(spark, path, most_rows=rows // 8)
    upsert_lake(spark, src.where("o_orderkey % 2 = 0"), path, "o_orderkey")
    split_lake(spark, path, most_rows=rows // 24)
    upsert_lake(spark, src.where("o_orderkey % 2 = 1"), path, "o_orderkey")
    return read_lake(spark, path)


# ---------------------------------------------------------------- two nights of the whole flow
from tidemark.operators import row_counts  # noqa: E402
from tidemark.plans.control_queries import fixture_config  # noqa: E402
from tidemark.plans.fixture_queries import TABLE_KEYS  # noqa: E402
from tidemark.plans.loads import file_source, nightly_lake_run  # noqa: E402
from tidemark.sources.files import FIXTURE_TABLES  # noqa: E402

NIGHT_1, NIGHT_2 = "2001-06-01", "2001-08-02"
TIME_COLS = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
NIGHTLY_BUCKETS = 8


def nightly_config(spark, sf_dir):
    cfg = fixture_config(spark, sf_dir)
    tc = F.lit(None).cast("string")
    for t, c in TIME_COLS.items():
        tc = F.when(F.col("tablename") == t, F.lit(c)).otherwise(tc)
    return cfg.withColumn("timecols", tc)


def _dup_sql(table: str, keys: str, time_col: str) -> str:
    ks = keys.split("|")
    present = " AND ".join(f"{k} IS NOT NULL" for k in ks)
    return (f"SELECT '{table}' AS tablename, EXISTS (SELECT 1 FROM {table} WHERE {time_col} >= TIMESTAMP '{NIGHT_1}' "
            f"AND {present} GROUP BY {', '.join(ks)} HAVING COUNT(*) > 1) AS has_dup")


@register("nightly_runs_fixture", f"""
WITH cnt AS ({" UNION ALL ".join(f"SELECT '{t}' AS tablename, COUNT(*) AS n FROM {t}" for t in FIXTURE_TABLES)}),
dup AS ({" UNION ALL ".join(_dup_sql(t, TABLE_KEYS[t], c) for t, c in TIME_COLS.items())})
SELECT cnt.tablename, 'dw_' || cnt.tablename AS targettable,
       CASE WHEN coalesce(dup.has_dup, false) THEN '{NIGHT_1}' ELSE '{NIGHT_2}' END AS watermark,
       CASE WHEN coalesce(dup.has_dup, false) THEN 'FAILED' ELSE 'SUCCESS' END AS comments,
       cnt.n AS lake_rows
FROM cnt LEFT JOIN dup ON cnt.tablename = dup.tablename""")
def q_nightly_runs_fixture(spark, sf_dir):
    """Night 1: every table is new → full loads. Night 2: tables with a time
    column load incrementally (MERGE of the slice since night 1); a slice with
    duplicate keys fails that table only, which keeps its night-1 watermark."""
    lake = shared_dir(spark, "nightly")
    cfg = two_nights(spark, sf_dir, lake)
    lake_rows = row_counts({f"dw_{t}": read_lake(spark, f"{lake}/dw_{t}") for t in FIXTURE_TABLES})
    out = cfg.join(lake_rows, cfg["targettable"] == lake_rows["table_name"], "left")
    return out.select("tablename", "targettable", "watermark", "comments", F.col("n_rows").alias("lake_rows"))


def two_nights(spark, sf_dir, lake):
    """Load all tables on two nights; between them the source changes the recent orders. Returns the new config."""
    cfg = nightly_config(spark, sf_dir)
    conns = cfg.select(F.col("dbname").alias("db_name"), F.lit("local").alias("host_port"),
                       F.lit("loader").alias("username"), F.lit("unused").alias("passwd")).distinct()
    before = file_source(sf_dir)

    def after(session, task):
        df = before(session, task)
        return df.withColumn("o_orderstatus", F.lit("X")) if task.tablename == "orders" else df

    _, cfg2 = nightly_lake_run(spark, cfg, conns, NIGHT_1, before, lake, parallelism=4, n_buckets=NIGHTLY_BUCKETS)
    _, cfg3 = nightly_lake_run(spark, cfg2, conns, NIGHT_2, after, lake, parallelism=4, n_buckets=NIGHTLY_BUCKETS)
    return cfg3


@register("nightly_lake_orders", f"""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= TIMESTAMP '{NIGHT_1}' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def q_nightly_lake_orders(spark, sf_dir):
    """The lake's orders after two nights: rows since the first watermark as the second night found them."""
    lake = shared_dir(spark, "nightly")
    two_nights(spark, sf_dir, lake)
    return read_lake(spark, f"{lake}/dw_orders")


# ---------------------------------------------------------------- delete by keys on a keyed lake table
from tidemark.plans.fixture_queries import _t, recent_order_customers  # noqa: E402
from tidemark.sinks.lake import delete_from_lake  # noqa: E402


@register("lake_delete_customer", REGISTRY["delete_by_keys_customer"][1])
def q_lake_delete_customer(spark, sf_dir):
    path = shared_dir(spark, "lake") + "/customer"
    overwrite_lake(spark, _t(spark, sf_dir, "customer"), path, keys="c_custkey", n_buckets=LAKE_BUCKETS)
    delete_from_lake(spark, recent_order_customers(spark, sf_dir), path, "c_custkey")
    return read_lake(spark, path)


# ---------------------------------------------------------------- stored layout; warehouses
from tidemark.plans.fixture_queries import EVENTS_WATERMARK, ORDERS_WATERMARK, events_with_epoch  # noqa: E402
from tidemark.plans.loads import LakeWarehouse, LoadTask, load_to_warehouse, publish_to_warehouse, source_slice  # noqa: E402


@register("lake_layout_orders", f"""
SELECT * FROM ({REGISTRY["merge_upsert_orders"][1]}) WHERE o_orderkey % 10 <> 3""")
def q_lake_layout_orders(spark, sf_dir):
    """Written with one bucket count; the upsert asks for another and the delete for none: the stored one holds."""
    path = shared_dir(spark, "lake") + "/orders"
    overwrite_lake(spark, orders_target(spark, sf_dir), path, keys="o_orderkey", n_buckets=32)
    upsert_lake(spark, orders_source(spark, sf_dir), path, "O_ORDERKEY", n_buckets=7)
    gone = _t(spark, sf_dir, "orders").where("o_orderkey % 10 = 3").select("o_orderkey")
    delete_from_lake(spark, gone, path, "o_orderkey")
    return read_lake(spark, path)


_STALE_SQL = f"""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= TIMESTAMP '{ORDERS_WATERMARK}' THEN o_orderstatus ELSE 'OLD' END
         AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"""


def _orders_task(mode: str) -> LoadTask:
    return LoadTask("orders", "fixtures", "orders", ("o_orderkey",), ("o_orderdate",), ORDERS_WATERMARK, mode)


def _stale_orders(spark, sf_dir):
    """What the warehouse held before: every second order, all with an old status."""
    return _t(spark, sf_dir, "orders").where("o_orderdate < '2001-07-01' OR o_orderkey % 2 = 0").withColumn(
        "o_orderstatus", F.lit("OLD"))


@register("publish_warehouse_orders", _STALE_SQL)
def q_publish_warehouse_orders(spark, sf_dir):
    """Lake → warehouse: the lake's slice since the watermark replaces the warehouse's rows by key."""
    base = shared_dir(spark, "publish")
    overwrite_lake(spark, _t(spark, sf_dir, "orders"), f"{base}/lake/orders", keys="o_orderkey", n_buckets=LAKE_BUCKETS)
    warehouse = LakeWarehouse(f"{base}/warehouse", n_buckets=LAKE_BUCKETS)
    warehouse.replace(spark, _stale_orders(spark, sf_dir), "orders", ("o_orderkey",))
    publish_to_warehouse(spark, _orders_task("incremental"), f"{base}/lake", warehouse)
    return warehouse.read(spark, "orders")


@register("direct_warehouse_orders", _STALE_SQL)
def q_direct_warehouse_orders(spark, sf_dir):
    """Source → warehouse: a full load of the stale rows, then the slice of the source by key."""
    warehouse = LakeWarehouse(shared_dir(spark, "direct"), n_buckets=LAKE_BUCKETS)
    load_to_warehouse(spark, _orders_task("full"), lambda s, t: _stale_orders(s, sf_dir), warehouse)
    load_to_warehouse(spark, _orders_task("incremental"), file_source(sf_dir), warehouse)
    return warehouse.read(spark, "orders")


@register("incremental_events_tz", f"""
SELECT event_id, ts_epoch FROM (SELECT event_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS ts_epoch FROM events)
WHERE ts_epoch >= CAST(epoch(TIMESTAMP '{EVENTS_WATERMARK}' - INTERVAL 8 HOUR) AS BIGINT)""")
def q_incremental_events_tz(spark, sf_dir):
    """A task whose source's clock is at +8: its midnight is 16:00 UTC of the day before."""
    task = LoadTask("events", "fixtures", "events", ("event_id",), ("ts_epoch",), EVENTS_WATERMARK, "incremental",
                    tz="Asia/Shanghai", epoch_unit="s")
    return source_slice(spark, task, lambda s, t: events_with_epoch(s, sf_dir).select("event_id", "ts_epoch"))


# ---------------------------------------------------------------- zone maps
from tidemark.sinks.zones import refresh_zones  # noqa: E402


@register("publish_zonemap_orders", _STALE_SQL)
def q_publish_zonemap_orders(spark, sf_dir):
    """The lake holds old orders in its base and the recent ones in a delta: the slice opens no base file."""
    base, orders = shared_dir(spark, "publish"), _t(spark, sf_dir, "orders")
    path = f"{base}/lake/orders"
    recent = F.col("o_orderdate") >= F.lit(ORDERS_WATERMARK).cast("timestamp_ntz")
    overwrite_lake(spark, orders.where(~recent), path, keys="o_orderkey", n_buckets=LAKE_BUCKETS)
    refresh_zones(spark, path, "o_orderdate")
    upsert_lake(spark, orders.where(recent), path, "o_orderkey", as_delta=True)
    warehouse = LakeWarehouse(f"{base}/warehouse", n_buckets=LAKE_BUCKETS)
    warehouse.replace(spark, _stale_orders(spark, sf_dir), "orders", ("o_orderkey",))
    publish_to_warehouse(spark, _orders_task("incremental"), f"{base}/lake", warehouse)
    return warehouse.read(spark, "orders")


# ---------------------------------------------------------------- loads that go on where they stopped
from tidemark.plans.resumable import resumable_load  # noqa: E402


@register("resumed_load_lineitem", "SELECT * FROM lineitem")
def q_resumed_load_lineitem(spark, sf_dir):
    """The source is lost after half of the ranges; the second try loads the others and replaces the table."""
    base, lineitem = shared_dir(spark, "resumed"), _t(spark, sf_dir, "lineitem")
    per_range = max(1, lineitem.count() // 6)

    def lost(range_id, rows):
        if range_id == 3:
            raise ConnectionError("the source is gone")
        return rows

    for on_range in (lost, None):
        try:
            resumable_load(spark, lineitem, f"{base}/lineitem", "l_orderkey", f"{base}/staging", keys="l_orderkey|l_linenumber",
                           rows_per_range=per_range, n_buckets=LAKE_BUCKETS, on_range=on_range)
        except ConnectionError:
            continue
    return read_lake(spark, f"{base}/lineitem")


# ---------------------------------------------------------------- reloads by digests, counts while writing
from tidemark.operators.upsert import merge_observed  # noqa: E402
from tidemark.sinks.digests import reload_lake  # noqa: E402


@register("digest_reload_customer", """
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 97 = 0 THEN 0 ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer WHERE c_custkey % 89 <> 1""")
def q_digest_reload_customer(spark, sf_dir):
    """The table is loaded twice; the second source lacks some rows and has others changed."""
    path, customer = shared_dir(spark, "lake") + "/customer", _t(spark, sf_dir, "customer")
    reload_lake(spark, customer, path, "c_custkey", n_buckets=LAKE_BUCKETS)
    changed = F.when(F.col("c_custkey") % 97 == 0, F.lit(0.0)).otherwise(F.col("c_acctbal"))
    reload_lake(spark, customer.where("c_custkey % 89 <> 1").withColumn("c_acctbal", changed), path, "c_custkey")
    return read_lake(spark, path)


@register("merge_observed_orders", REGISTRY["merge_metrics_orders"][1])
def q_merge_observed_orders(spark, sf_dir):
    """The counts of the merge, taken while its result is written."""
    path = shared_dir(spark, "merge") + "/orders"
    counts = merge_observed(orders_target(spark, sf_dir), orders_source(spark, sf_dir), "o_orderkey",
                            lambda merged: merged.write.parquet(path))
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} long" for name in counts))
