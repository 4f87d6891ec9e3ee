import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import batch_plan, hash_batches, page, rename_columns, row_counts, page_slice
from tidemark.operators.columns import parse_mapping


def test_rename_swap_chain_unknown(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert rename_columns(df, {"a": "b", "b": "a"}).columns == ["b", "a", "c"]
    assert rows(rename_columns(df, {"a": "b", "b": "a"}).select("a", "b")) == [(2, 1)]
    assert rename_columns(df, {"a": "b", "b": "c", "c": "d"}).columns == ["b", "c", "d"]
    assert rename_columns(df, '{"zz": "q"}').columns == ["a", "b", "c"]
    assert rename_columns(df, None).columns == ["a", "b", "c"]


def test_rename_matches_case_insensitively(spark):
    df = spark.createDataFrame([(1, 2)], "ID int, user_id int")
    assert rename_columns(df, {"id": "pk"}).columns == ["pk", "user_id"]


def test_rename_collision_and_bad_json(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError):
        rename_columns(df, {"a": "b"})
    with pytest.raises(ValueError):
        parse_mapping('{"a": ')
    with pytest.raises(ValueError):
        parse_mapping('["a"]')


def test_pages_disjoint_cover_and_sized(spark):
    df = spark.range(0, 1003).select((F.col("id") * 7 % 1003).alias("k"), F.col("id").alias("v"))
    p = page(df, "k", 100, rows_per_bucket=97)
    got = p.collect()
    assert len(got) == 1003
    assert sorted(r.row_index for r in got) == list(range(1003))
    for r in got:
        assert r.row_index == r.k  # keys are a permutation of 0..1002
        assert r.batch_id == r.k // 100
    sizes = {r.batch_id: r["count"] for r in p.groupBy("batch_id").count().collect()}
    assert sizes == {i: 100 for i in range(10)} | {10: 3}


def test_pages_nulls_first_and_single_bucket(spark):
    df = spark.createDataFrame([(None,), (5,), (3,)], "k int")
    got = sorted((r.row_index, r.k) for r in page(df, "k", 2).collect())
    assert got == [(0, None), (1, 3), (2, 5)]


def test_hash_batches_complete(spark):
    df = spark.range(0, 500).withColumn("k2", F.col("id") % 3)
    b = hash_batches(df, "id|k2", 7)
    assert b.count() == 500 and b.select("batch_id").distinct().count() <= 7
    assert b.filter((F.col("batch_id") < 0) | (F.col("batch_id") >= 7)).count() == 0


def test_batch_plan_and_counts(spark):
    t = {"a": spark.range(0, 12), "b": spark.range(0, 3)}
    plan = {r.table_name: (r.n_rows, r.is_huge, r.n_batches) for r in batch_plan(row_counts(t), 10, 5).collect()}
    assert plan == {"a": (12, True, 3), "b": (3, False, 0)}
    with pytest.raises(ValueError):
        batch_plan(row_counts(t), 10, 0)


def test_pages_split_a_hot_key_and_hot_nulls(spark):
    # key 5 holds a third of the rows, NULL another sixth
    data = [(5 if i % 3 == 0 else (None if i % 6 == 1 else i), i) for i in range(600)]
    df = spark.createDataFrame(data, "k int, v int")
    p = page(df, "k", 50, rows_per_bucket=40)
    got = p.collect()
    assert sorted(r.row_index for r in got) == list(range(600))
    ordered = [r.k for r in sorted(got, key=lambda r: r.row_index)]
    n_null = sum(1 for k, _ in data if k is None)
    assert ordered[:n_null] == [None] * n_null
    assert ordered[n_null:] == sorted(k for k, _ in data if k is not None)
    assert all(r["count"] == 50 for r in p.groupBy("batch_id").count().collect())
    # no sort group (range partition) is much larger than rows_per_bucket
    from tidemark.operators.paging import positions, row_hash
    groups = positions(df.withColumn("_h", row_hash(df)), "k", 40).groupBy("_p").count().collect()
    assert max(r["count"] for r in groups) <= 3 * 40, sorted(r["count"] for r in groups)


def test_small_buckets_of_many_rows_stay_few_partitions(spark):
    from tidemark.operators.paging import n_buckets, positions, row_hash
    df = spark.range(0, 3000).select((F.col("id") * 7 % 3000).alias("k"))
    assert positions(df.withColumn("_h", row_hash(df)), "k", 5).agg(F.max("_p")).collect()[0][0] < 100
    got = page(df, "k", 100, rows_per_bucket=5).collect()
    assert len(got) == 3000 and all(r.row_index == r.k and r.batch_id == r.k // 100 for r in got)
    assert n_buckets(0, 5) == 1 and n_buckets(97, 10) == 10
    assert n_buckets(54_000_000, 300) == n_buckets(54_000_000, 1000) == 216
    assert n_buckets(54_000_000, 4_000_000) == 14


@pytest.mark.parametrize("kind", ["bigint", "decimal(38,0)", "string", "date"])
def test_pages_of_any_orderable_key(spark, kind):
    """Keys above 2^53, wide decimals, text and dates keep their exact order."""
    base = {"bigint": F.lit(2 ** 60) + F.col("id"), "decimal(38,0)": F.lit(str(10 ** 20)).cast("decimal(38,0)") + F.col("id"),
            "string": F.format_string("k%06d", F.col("id")), "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int"))}
    df = spark.range(256).select(base[kind].cast(kind).alias("k"), F.col("id").alias("v"))
    got = page(df, "k", 50, rows_per_bucket=20).collect()
    assert all(r.row_index == r.v for r in got) and len(got) == 256
    some = page_slice(df, "k", 50, 2, rows_per_bucket=20).collect()
    assert sorted((r.row_index, r.v) for r in some) == [(i, i) for i in range(100, 150)]


def test_page_slices_cover_ties_and_nulls(spark):
    data = [(None if i % 5 == 0 else i % 3, i % 4) for i in range(97)]
    df = spark.createDataFrame(data, "k int, v int")
    seen = [r for b in range(6) for r in page_slice(df, "k", 20, b, rows_per_bucket=7).collect()]
    assert sorted(r.row_index for r in seen) == list(range(97))
    assert sorted(((r.k, r.v) for r in seen), key=str) == sorted(data, key=str)
    ordered = [(r.k is not None, r.k or 0) for r in sorted(seen, key=lambda r: r.row_index)]
    assert ordered == sorted(ordered)
    assert page_slice(df, "k", 20, 9, rows_per_bucket=7).count() == 0


def test_page_slice_reads_between_its_ends(spark, tmp_dir):
    path = tmp_dir + "/t"
    spark.range(5000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("wide")).write.parquet(path)
    rows = page_slice(spark.read.parquet(path), "k", 100, 3, rows_per_bucket=500)
    assert sorted(r.k for r in rows.collect()) == list(range(300, 400))


def test_selection_narrows_every_kind_of_key(spark, monkeypatch):
    """Few bins and a small remainder: many passes, ties, nulls, wide and close values, shared prefixes."""
    import datetime as dt
    import decimal
    import random

    from tidemark.operators import paging, selection

    monkeypatch.setattr(selection, "BINS", 8)
    monkeypatch.setattr(paging, "SPARE_ROWS", 3)
    rng = random.Random(4)
    near = 1 << 61
    kinds = {
        "bigint": [rng.choice([-(1 << 63), (1 << 63) - 1, near + rng.randrange(40), rng.randrange(-50, 50)]) for _ in range(150)],
        "decimal(38,2)": [decimal.Decimal(rng.choice([10**35, -5, 7])) + decimal.Decimal(rng.randrange(60)) / 100 for _ in range(150)],
        "date": [dt.date(2024, 1, 1) + dt.timedelta(days=int(rng.expovariate(0.05))) for _ in range(150)],
        "timestamp_ntz": [dt.datetime(2024, 3, 31, 1, 59) + dt.timedelta(microseconds=rng.choice([1, 60_000_000, 7_000_000_000]) * rng.randrange(30)) for _ in range(150)],
        "timestamp": [dt.datetime(2024, 3, 31, 1, 59) + dt.timedelta(microseconds=rng.choice([1, 90_000_000]) * rng.randrange(30)) for _ in range(150)],
        "string": [rng.choice(["", "customer#00000", "é", "customer#00000\U0001F600", "z" * 30]) + str(rng.randrange(30)) for _ in range(150)],
        "float": [rng.choice([float("nan"), 1.5, -2.25, rng.random()]) for _ in range(150)],
    }
    for kind, keys in kinds.items():
        rows_ = [(None if i % 9 == 0 else keys[3] if i % 3 == 0 else k, i) for i, k in enumerate(keys)]
        df = spark.createDataFrame(rows_, f"k {kind}, v int").repartition(3).cache()
        want = [(r.v, r.row_index) for r in page(df, "k", 40).collect()]
        got = [(r.v, r.row_index) for b in (range(5) if kind in ("bigint", "string") else (0, 2)) for r in page_slice(df, "k", 40, b).collect()]
        inside = [w for w in want if kind in ("bigint", "string") or w[1] < 40 or 80 <= w[1] < 120]
        assert sorted(got) == sorted(inside), kind
        df.unpersist()


def test_selection_shuffles_no_table(spark, tmp_dir):
    """Each pass sends a row a bin; the page is read by a filter on the key that reaches the scan."""
    path = tmp_dir + "/t"
    spark.range(0, 50_000, 1, 4).selectExpr("id * 3 AS k", "CAST(id AS STRING) AS v").write.parquet(path)
    df = page_slice(spark.read.parquet(path), "k", 100, 30)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(k), GreaterThanOrEqual(k," in plan and plan.count("Exchange") == 1
    got = sorted(df.collect())
    assert [r.k for r in got] == [3 * i for i in range(3000, 3100)] and [r.row_index for r in got] == list(range(3000, 3100))
    whole = df._jdf.queryExecution().analyzed().toString()
    low, high = (int(x.split("cast(")[-1].split(" ")[0]) for x in whole.split("Filter")[-1].split(" AND "))
    assert high - low < 3 * (2 * 100 + 10_000 + 50)
