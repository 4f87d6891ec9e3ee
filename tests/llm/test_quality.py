"""The quality classifier: held-out accuracy, calibration, defined cases."""
import numpy as np
from edges import edge_docs, empty_docs, rows_of

from tidemark.llm.rff_quality import Features, N_STATISTICS, pooled_violators, quality_scores, statistics


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality_scores(docs, labels).collect()}
    held = [(got[d], q) for d, q in rows_of(labels, "doc_id", "quality") if got[d].held_out]
    assert len(held) > 50
    assert np.mean([r.predicted == q for r, q in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_held_out_labels_are_not_learned_from(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    first = {r.doc_id: (r.score, r.held_out) for r in quality_scores(docs, labels).collect()}
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    again = {r.doc_id: r.score for r in quality_scores(docs, turned).collect()}
    assert any(h for _, h in first.values())
    assert all(np.isclose(s, again[d]) for d, (s, _) in first.items())


def test_edge_rows(spark):
    docs = edge_docs(spark)
    marked = labels_of(spark, [(i * 20, i % 2, 0) for i in range(14)] + [(20, None, None), (None, 1, 0), (0, 1, 0), (99999, 0, 0), (20, 7, 0)])
    got = quality_scores(docs, marked).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    none = quality_scores(docs, marked.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    one = quality_scores(docs, marked.where("quality = 0")).collect()
    assert {(r.score, r.predicted) for r in one} == {(0.0, 0)}
    assert quality_scores(empty_docs(spark), marked).count() == 0


def test_pooled_violators_are_monotone_least_squares():
    total = np.array([0, 4, 0, 5, 2, 0, 8, 1, 0.0])
    positive = np.array([0, 1, 0, 4, 0, 0, 4, 1, 0.0])
    rate = pooled_violators(total, positive)
    assert (np.diff(rate) >= -1e-12).all()
    assert np.isclose(rate[1], 0.25) and np.isclose(rate[3], rate[4]) and np.isclose(rate[3], 8 / 15) and rate[7] == 1


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((30, N_STATISTICS)) * 0.5
    f = Features(np.zeros(N_STATISTICS), np.ones(N_STATISTICS), 20_000, 3.0, 7)
    z = f(x)[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * 3.0 ** 2))
    assert np.abs(z @ z.T - kernel).max() < 0.05


def test_statistics_are_finite():
    for t in ("", " ", "\n", "a", "#", "x" * 100_000, "a " * 50_000, "  ", "🙂" * 10):
        assert len(statistics(t)) == N_STATISTICS and np.isfinite(statistics(t)).all()
