import datetime

import pytest

from tidemark.sources.jdbc import (
    jdbc_read_options, jdbc_write_options, swap_statements, with_zero_dates_as_null,
)


def test_zero_dates_url():
    assert with_zero_dates_as_null("jdbc:mysql://h:3306/db") == "jdbc:mysql://h:3306/db?zeroDateTimeBehavior=convertToNull"
    assert with_zero_dates_as_null("jdbc:mysql://h/db?a=1").endswith("?a=1&zeroDateTimeBehavior=convertToNull")
    assert with_zero_dates_as_null("jdbc:oracle:thin:@h:1521:x") == "jdbc:oracle:thin:@h:1521:x"


def test_read_options_partitioned_and_query():
    o = jdbc_read_options("jdbc:mysql://h/db", "db.t", user="u", password="p", partition_column="id",
                          lower_bound=1, upper_bound=100, num_partitions=8)
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "8" and o["lowerBound"] == "1"
    assert o["dbtable"] == "db.t" and "zeroDateTimeBehavior" in o["url"]
    q = jdbc_read_options("jdbc:mysql://h/db", query="select * from t where x > 1")
    assert q["dbtable"].startswith("(select * from t where x > 1)")
    with pytest.raises(ValueError):
        jdbc_read_options("u", "t", query="q")
    with pytest.raises(ValueError):
        jdbc_read_options("u", "t", partition_column="id", num_partitions=4)


def test_write_options():
    o = jdbc_write_options("jdbc:oracle:thin:@h", "DW.t", truncate=True, num_partitions=20,
                           column_types="name VARCHAR(100)")
    assert o == {"url": "jdbc:oracle:thin:@h", "dbtable": "DW.t", "batchsize": "10000", "truncate": "true",
                 "numPartitions": "20", "createTableColumnTypes": "name VARCHAR(100)"}


def test_swap_statements():
    d, i = swap_statements("DW.t", "DW.t_tmp", "id|shop", ["id", "shop", "v"])
    assert d == 'DELETE FROM DW.t WHERE ("id", "shop") IN (SELECT "id", "shop" FROM DW.t_tmp)'
    assert i == 'INSERT INTO DW.t ("id", "shop", "v") SELECT "id", "shop", "v" FROM DW.t_tmp'


def test_range_predicates_are_disjoint_and_cover():
    from tidemark.sources.jdbc import ntile_bounds_query, range_predicates

    preds = range_predicates("k", [30, 10, 10, 20])
    assert preds == ["k <= 10", "k > 10 AND k <= 20", "k > 20 AND k <= 30", "k > 30", "k IS NULL"]

    def holds(pred, k):
        if pred == "k IS NULL":
            return k is None
        if k is None:
            return False
        env = {"k": k}
        return eval(pred.replace("AND", "and").replace("IS NOT NULL", "is not None"), {}, env)

    for k in [None, -5, 10, 11, 20, 25, 30, 31, 1000]:
        assert sum(holds(p, k) for p in preds) == 1, k
    assert range_predicates("d", [datetime.date(2024, 1, 1)])[0] == "d <= '2024-01-01'"
    assert range_predicates("t", [datetime.datetime(2024, 1, 1, 5)])[0] == "t <= '2024-01-01 05:00:00'"
    for bad in (["O'Brien"], [b"x"], [True]):
        with pytest.raises(TypeError):
            range_predicates("n", bad)
    assert range_predicates("k", []) == ["k IS NOT NULL", "k IS NULL"]
    assert "NTILE(8) OVER (ORDER BY id)" in ntile_bounds_query("db.t", "id", 8)
