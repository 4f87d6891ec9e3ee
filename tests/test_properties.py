"""Randomised checks against plain-Python brute force (small frames)."""
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import MergeAmbiguityError, merge_metrics, merge_upsert, page, stage_swap

SCHEMA = "k int, v string"
keys = st.one_of(st.none(), st.integers(min_value=0, max_value=6))
frames = st.lists(st.tuples(keys, st.sampled_from(["a", "b", "c"])), max_size=12)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def brute_swap(target, source):
    src_keys = {k for k, _ in source if k is not None}
    return [r for r in target if r[0] is None or r[0] not in src_keys] + list(source)


@SETTINGS
@given(target=frames, source=frames)
def test_merge_and_swap_match_brute_force(spark, target, source):
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SCHEMA)
    expected = Counter(brute_swap(target, source))
    assert Counter(tuple(r) for r in stage_swap(t, s, "k").collect()) == expected

    src_counts = Counter(k for k, _ in source if k is not None)
    ambiguous = any(src_counts[k] > 1 for k, _ in target if k is not None)
    try:
        got = Counter(tuple(r) for r in merge_upsert(t, s, "k").collect())
        assert not ambiguous and got == expected
    except MergeAmbiguityError:
        assert ambiguous

    m = merge_metrics(t, s, "k").first()
    tgt_keys = {k for k, _ in target if k is not None}
    updated = sum(1 for k, _ in target if k is not None and k in src_counts)
    inserted = sum(1 for k, _ in source if k is None or k not in tgt_keys)
    assert (m.rows_updated, m.rows_inserted, m.rows_untouched) == (updated, inserted, len(target) - updated)
    assert m.rows_after == len(target) - updated + len(source)


@SETTINGS
@given(rows=st.lists(keys, min_size=1, max_size=40), batch=st.integers(min_value=1, max_value=7),
       per_bucket=st.integers(min_value=1, max_value=9))
def test_page_matches_sorted_positions(spark, rows, batch, per_bucket):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(rows)], "k int, id int")
    got = page(df, "k", batch, rows_per_bucket=per_bucket).collect()
    assert sorted(r.row_index for r in got) == list(range(len(rows)))
    ordered = sorted(got, key=lambda r: r.row_index)
    ks = [r.k for r in ordered]
    assert ks == sorted(ks, key=lambda k: (k is not None, k if k is not None else 0))  # NULLs first, then ascending
    assert all(r.batch_id == r.row_index // batch for r in got)


@SETTINGS
@given(rows=st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(0, 2))), max_size=20))
def test_unique_check_matches_brute_force(spark, rows):
    from tidemark.operators import unique_check

    df = spark.createDataFrame(rows, "a int, b int")
    r = unique_check(df, "a|b").first()
    counts = Counter(rows)
    null_rows = sum(n for (a, b), n in counts.items() if a is None or b is None)
    assert (r.n_rows, r.n_keys, r.n_dup_keys, r.n_null_key_rows) == (
        len(rows), len(counts), sum(1 for n in counts.values() if n > 1), null_rows)
    assert r.is_unique == (len(counts) == len(rows) and null_rows == 0)


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 30)), st.one_of(st.none(), st.integers(0, 30))),
                     max_size=20),
       wm_day=st.integers(1, 28))
def test_incremental_filter_matches_brute_force(spark, rows, wm_day):
    import datetime as dt

    from tidemark.operators import incremental_filter

    base = dt.date(2024, 1, 1)
    data = [(i, None if a is None else base + dt.timedelta(days=a),
             None if b is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=b, hours=5))
            for i, (a, b) in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, d date, t timestamp_ntz")
    wm = dt.date(2024, 1, wm_day)
    got = sorted(r.id for r in incremental_filter(df, ["d", "t"], wm.isoformat()).collect())
    want = sorted(i for i, d, t in data
                  if (d is not None and d >= wm) or (t is not None and t >= dt.datetime.combine(wm, dt.time())))
    assert got == want
