"""Embedding near-duplicates against all pairs."""
import numpy as np
import pytest

from tidemark.llm.cross_polytope import buckets, fast_hadamard, near_duplicates


def brute(rows):
    """(n_links, component) of every row by comparing all pairs."""
    unit = []
    for _, v in rows:
        ok = v and None not in v and np.isfinite(v).all() and np.any(v)
        unit.append(np.array(v, float) / np.linalg.norm(v) if ok else None)
    n = len(rows)
    near = lambda i, j: (unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j])
                         and rows[i][0] is not None and rows[j][0] is not None and unit[i] @ unit[j] >= 0.9)
    links, label = [0] * n, list(range(n))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(n):
        for j in range(i):
            if near(i, j):
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                label[b] = a
    least: dict = {}
    for i, (vec, _) in enumerate(rows):
        if vec is not None:
            least[find(i)] = min(vec, least.get(find(i), vec))
    return sorted(((vec, links[i], least.get(find(i))) for i, (vec, _) in enumerate(rows)), key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v and [x if x is None else float(x) for x in v], "t") for i, v in rows], "vec_id long, embedding array<float>, lane string").repartition(3)
    got = near_duplicates(df, **options).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str)


def planted(seed, spreads=(0.02, 0.03, 0.04, 0.045, 0.05), size=40):
    rng = np.random.default_rng(seed)
    out = []
    for s in spreads:
        c = rng.standard_normal(64)
        z = c / np.linalg.norm(c) + rng.standard_normal((size, 64)) * s
        out += [*z, *z[:4]]
    out += [*rng.standard_normal((60, 64))]
    return [(3 * i + 1, [float(np.float32(x)) for x in v]) for i, v in enumerate(out)]


@pytest.mark.parametrize("block", [1000, 15])
def test_planted_groups(spark, block):
    """Groups in one task, or their cores by the mean and the rest in blocks."""
    rows = planted(1)
    assert run(spark, rows, block=block) == brute(rows)


def test_recall_of_links_is_high(spark):
    rows = planted(2, spreads=(0.038, 0.04, 0.042, 0.044, 0.046, 0.048), size=25)
    got, want = run(spark, rows), brute(rows)
    assert sum(r[1] for r in got) >= 0.98 * sum(r[1] for r in want)


def test_edge_vectors(spark):
    v = [0.5, -1.0, 2.0, 0.25]
    rows = [(1, v), (2, [2 * x for x in v]), (3, v), (3, v), (None, v), (5, None), (6, []), (7, [0.0] * 4), (8, [float("nan"), 1, 1, 1]),
            (9, [float("inf"), 1, 1, 1]), (10, [None, 1.0, 1.0, 1.0]), (11, [0.5, -1.0, 2.0]), (12, [0.5, -1.0, 2.0]), (13, [1.0]), (14, [-1.0]),
            (15, [3e38, 3e38, 0.0, 0.0]), (16, [1e-30, 1e-30, 0.0, 0.0])]
    assert run(spark, rows) == brute(rows)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_duplicates(empty).count() == 0


def test_fast_hadamard_is_the_hadamard_matrix():
    h = np.array([[1.0]])
    while len(h) < 16:
        h = np.block([[h, h], [h, -h]])
    x = np.random.default_rng(4).standard_normal((5, 16))
    assert np.allclose(fast_hadamard(x), x @ h)


def test_near_vectors_share_buckets():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((200, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x + rng.standard_normal(x.shape) * 0.03
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    a, b = (buckets(v, 10, 3, 3, 5).reshape(200, -1) for v in (x, y))
    shared = np.array([len(set(p) & set(q)) for p, q in zip(a, b)])
    assert (shared > 0).mean() > 0.99
    apart = np.array([len(set(p) & set(q)) for p, q in zip(a, b[::-1])])
    assert (apart > 0).mean() < 0.1
