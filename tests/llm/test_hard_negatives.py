"""Hard negatives against all pairs in whole numbers."""
import math

import numpy as np
import pytest

from tidemark.llm.inverted_multi_index import Index, first_in_order, hard_negatives, nearest, scores


def brute(rows, every=100, take=5):
    """rows: (vec_id, vector, label)."""
    valid = {(i, lab, tuple(math.floor(256 * x) for x in v)) for i, v, lab in rows
             if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for i, lab, q in (r for r in valid if r[0] % every == 0):
        scored = {(-sum(x * y for x, y in zip(q, p, strict=True)), j, other == lab) for j, other, p in valid if j != i}
        same = sorted((s, j) for s, j, eq in scored if eq)[:take]
        rest = sorted((s, j) for s, j, eq in scored if not eq)
        for s, j in same:
            inside = [(-t, k) for t, k in rest if 80 * -s <= 100 * -t <= 100 * -s][:take]
            out |= {(i, j, rank, k, -s, t) for rank, (t, k) in enumerate(inside, 1)}
    return sorted(out)


def run(spark, rows, every=100, **options):
    df = spark.createDataFrame([(i, v and [x if x is None else float(x) for x in v], lab, "t", 1) for i, v, lab in rows],
                               "vec_id long, embedding array<float>, label int, lane string, a int").repartition(4)
    return sorted(map(tuple, hard_negatives(df, lambda c: c % every == 0, **options).collect()))


def planted(seed, n=400, width=8, spread=0.15):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, width))
    v = centres[rng.integers(0, 12, n)] + rng.standard_normal((n, width)) * spread
    return [(7 * i, [float(np.float32(x)) for x in v[i]], int(rng.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"cell_rows": 8, "first_rows": 30, "lane_rows": 8}, {"fit_rows": 20, "first_rows": 1, "cell_rows": 3}])
def test_groups_match_all_pairs(spark, options):
    rows = planted(1)
    got = run(spark, rows, every=20, **options)
    assert got == brute(rows, every=20) and len(got) > 400


def test_vectors_without_groups(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(9)], int(i % 2)) for i in range(300)]
    assert run(spark, rows, every=10, cell_rows=10, first_rows=40) == brute(rows, every=10)


def test_a_common_vector_ties_and_repeated_rows(spark):
    """A third of all rows are one vector; rows come twice; one id has two vectors and two labels."""
    rows = planted(2, n=200)
    rows = [(i, rows[0][1] if i % 3 == 0 else v, lab) for i, v, lab in rows]
    rows += rows[:60] + [(rows[3][0], rows[50][1], 1), (rows[0][0], rows[9][1], 2), (rows[5][0], rows[5][1], 2)]
    got = run(spark, rows, every=50, cell_rows=6, lane_rows=4, first_rows=10)
    assert got == brute(rows, every=50) and got


def test_undefined_rows(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(0, None, 1), (100, [nan] * 8, 1), (200, [1.0] * 7 + [inf], 1), (300, [1.0] * 7 + [None], 1), (None, [1.0] * 8, 1),
           (400, [1.0] * 8, None), (500, [], 1), (600, [1.0] * 3, 1), (700, [0.0] * 8, 0), (800, [1e30] * 8, 1)]
    rows = planted(3, n=120)
    want = brute(rows + [bad[8]], every=100)
    assert run(spark, rows + bad, every=100, cell_rows=10) == want and want
    assert run(spark, bad[:1]) == [] and run(spark, []) == []
    assert run(spark, [(100, [1.0, 2.0], 1)]) == [] and run(spark, [(100, [1.0], 1), (5, [1.0], 1), (7, [0.9], 2)]) == [(100, 5, 1, 7, 65536, 58880)]


def test_cells_come_in_the_order_of_bounds_that_hold():
    rng = np.random.default_rng(5)
    x = rng.integers(-200, 200, (500, 6)).astype(float)
    halves = (x[:5, :3], x[5:11, 3:])
    (a, ra), (b, rb) = nearest(x[:, :3], halves[0]), nearest(x[:, 3:], halves[1])
    radii = (np.array([ra[a == k].max(initial=0) for k in range(5)]), np.array([rb[b == k].max(initial=0) for k in range(6)]))
    cells = {}
    for cell in zip(a.tolist(), b.tolist(), strict=True):
        cells[cell] = cells.get(cell, 0) + 1
    index = Index(halves, radii, cells)
    for q in x[:40]:
        seen = list(index.visit(q))
        assert [s for s, _ in seen] == sorted((s for s, _ in seen), reverse=True) and {c for _, c in seen} == set(cells)
        most = dict((c, s) for s, c in seen)
        assert all(x[i] @ q <= most[a[i], b[i]] for i in range(500))


def test_scores_are_exact_at_every_size():
    rng = np.random.default_rng(6)
    for top in (200, 1 << 18, (1 << 28) - 1):
        x, y = rng.integers(-top, top, (7, 16)), rng.integers(-top, top, (9, 16))
        assert scores(x.astype(np.int32), y.astype(np.int32)).tolist() == [[sum(int(p) * int(q) for p, q in zip(r, s, strict=True)) for s in y] for r in x]


def test_first_in_order_with_repeats():
    score, ids = np.array([5] * 40 + [4, 4, 3]), np.array([1] * 40 + [9, 8, 7])
    assert first_in_order(score, ids, 3) == [(5, 1), (4, 8), (4, 9)]
