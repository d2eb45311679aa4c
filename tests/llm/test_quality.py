"""Quality classifier: calibration, normal equations, held-out accuracy, defined cases."""

import numpy as np

from casetrail.llm import quality, queries


def test_pool_is_the_isotonic_fit():
    rng = np.random.default_rng(3)
    for _ in range(20):
        v, c = rng.random(9), rng.integers(1, 5, 9).astype(float)
        fit = quality.pool(v, c)
        # max-min formula of isotonic regression
        want = [max(min(np.average(v[a:b + 1], weights=c[a:b + 1]) for b in range(i, 9))
                    for a in range(i + 1)) for i in range(9)]
        assert np.allclose(fit, want)


def test_normal_equations_equal_a_direct_solution(spark):
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(200, len(quality.STATISTICS)))
    y = (rows[:, 0] > 0).astype(float)
    train = spark.createDataFrame([(r.tolist(), float(t)) for r, t in zip(rows, y)],
                                  "stats array<double>, y double").repartition(5)
    model = quality.fit(train)
    z = quality.features((rows - rows.mean(0)) / rows.std(0))
    want = np.linalg.solve(z.T @ z + quality.RIDGE * 200 / quality.FEATURES * np.eye(z.shape[1]),
                           z.T @ y)
    assert np.allclose(model.weights, want, atol=1e-6)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.op10_quality(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_defined_cases(spark):
    docs = spark.createDataFrame(
        [(i, "good words here now " * (i + 1), 0) for i in range(20)]
        + [(1, None, 1), (None, "", 1), (3, "x", 1), (3, "x", 1), (99, "y " * 50_000, 1)],
        "doc_id long, text string, stats int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(3, 0), (None, 1), (4, None)],
                                   "doc_id long, quality int")
    out = quality.classify(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    assert out.count() == 25
    none = quality.classify(docs, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    assert quality.classify(docs.limit(0), labels).collect() == []
