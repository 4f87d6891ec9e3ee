from conftest import rows
from tidemark.operators import distinct_keys, duplicate_keys, unique_check, unique_check_many


def test_unique_check_cases(spark):
    empty = spark.createDataFrame([], "k int, v string")
    r = unique_check(empty, "k", "empty").first()
    assert (r.n_rows, r.n_keys, r.is_unique, r.comment) == (0, 0, True, "Unique")

    nulls = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    r = unique_check(nulls, "k").first()
    assert (r.n_rows, r.n_keys, r.n_null_key_rows, r.is_unique, r.comment) == (2, 2, 1, False, "Not Unique")

    comp = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a")], "k int, v string")
    r = unique_check(comp, "k|v").first()
    assert (r.n_rows, r.n_keys, r.n_dup_keys, r.is_unique) == (3, 2, 1, False)
    r = unique_check(comp.distinct(), ["k", "v"]).first()
    assert r.is_unique


def test_first_group_is_not_the_verdict(spark):
    # one group of size 1 first, then a duplicate: must be Not Unique
    df = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    assert unique_check(df, "k").first().comment == "Not Unique"


def test_duplicate_and_distinct_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 4)], "a int, b int")
    assert rows(duplicate_keys(df, "a")) == [(1, 3), (None, 2)]
    assert rows(distinct_keys(df, "a")) == [(1,), (None,)]


def test_many_tables_one_frame(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(1,), (1,)], "k int")
    out = {r.table_name: r.comment for r in unique_check_many({"a": (a, "k"), "b": (b, "k")}).collect()}
    assert out == {"a": "Unique", "b": "Not Unique"}


def test_compact_checks_equal_the_grouped_one(spark):
    from tidemark.operators.bitmaps import compact_unique_check, measured_routes

    ends = [-(1 << 63), -(1 << 63) + 1, -32769, -32768, -32767, -1, 0, 1, 32768, 32769, (1 << 63) - 1]
    ints = lambda xs: spark.createDataFrame([(x, str(x)) for x in xs], "k bigint, v string").repartition(3)
    tables = {"ends": ints(ends), "repeated": ints([*ends, 7, 7, 7, 32768]), "nulls": ints([1, 2, None, None]), "one_null": ints([None, 5]),
              "empty": ints([]), "dense": spark.range(-5000, 70_000).selectExpr("id AS k", "'x' AS v"),
              "hot": spark.range(3000).selectExpr("IF(id % 3 = 0, 42, id) AS k", "'x' AS v")}
    for keys in ("k", "K|v", "v"):
        listed = {n: (df, keys) for n, df in tables.items()}
        want = rows(unique_check_many(listed))
        assert rows(compact_unique_check(listed)) == want
        assert rows(compact_unique_check(listed, routes=dict.fromkeys(listed, "hashes"))) == want
    assert rows(compact_unique_check({n: (df, "k") for n, df in tables.items()}, routes=dict.fromkeys(tables, "bitmap"))) == \
        rows(unique_check_many({n: (df, "k") for n, df in tables.items()}))
    thin = spark.range(5000).selectExpr("id * 100000000 AS k")
    assert measured_routes({"dense": (tables["dense"], ["k"]), "thin": (thin, ["k"]), "text": (tables["dense"], ["v"])}) == \
        {"dense": "bitmap", "thin": "hashes", "text": "hashes"}


def test_unique_keys_are_not_shuffled(spark):
    """Of a dense unique key one row a stretch of 32,768 values and task goes through the exchange."""
    from tidemark.operators.bitmaps import compact_unique_check

    df = spark.range(0, 300_000, 1, 4).withColumnRenamed("id", "k")
    report = compact_unique_check({"t": (df, "k")})
    assert report.first().is_unique
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "bitmap" in plan.lower() and "hashpartitioning(_stretch" in plan and "hashpartitioning(k" not in plan
    assert report.collect()[0].n_keys == 300_000
