"""Platt scaling: the Newton fit against a plain one, calibration, saving."""
import numpy as np
from pyspark.ml.functions import array_to_vector

from tabulark.ml import models as M


def test_newton_fit_equals_a_plain_one(spark):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(600, 3)) * 2
    y = (m + rng.normal(size=m.shape)).argmax(1)
    df = spark.createDataFrame([(float(c), [float(v) for v in r]) for c, r in zip(y, m)], "label double, _margin array<double>")
    for k, (a, b) in enumerate(M.fit_platt(df, 3)):
        n1, n0 = (y == k).sum(), (y != k).sum()
        t = np.where(y == k, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        w = np.zeros(2)
        z = np.stack([m[:, k], np.ones(len(m))], 1)
        for _ in range(100):
            p = 1 / (1 + np.exp(z @ w))
            w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z, z.T @ (t - p))
        assert np.allclose([a, b], w, atol=1e-5)


def test_probabilities_are_calibrated_and_saved(spark, tmp_path):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1600, 2))
    y = (rng.random(1600) < 1 / (1 + np.exp(-(2 * x[:, 0] + x[:, 1] ** 2 - 1)))).astype(float)
    df = spark.createDataFrame([(i, [float(v) for v in r], float(c)) for i, (r, c) in enumerate(zip(x, y))], "id int, v array<double>, label double")
    df = df.select("id", array_to_vector("v").alias("features"), "label")
    f = M.fit_svm(df.where("id % 2 = 0"), 2, 2, n_components=60)
    out = M.predict(f, df.where("id % 2 = 1")).collect()
    p, t = np.array([r.probability[1] for r in out]), np.array([r.label for r in out])
    bins = np.clip((p * 5).astype(int), 0, 4)
    error = sum(abs(p[bins == b].mean() - t[bins == b].mean()) * (bins == b).mean() for b in range(5) if (bins == b).any())
    assert error < 0.08 and np.mean([r.prediction == r.label for r in out]) > 0.7
    M.save_fitted(f, f"{tmp_path}/svm")
    again = M.predict(M.load_fitted(spark, f"{tmp_path}/svm"), df.where("id % 2 = 1")).collect()
    assert [r.probability for r in again] == [r.probability for r in out]
