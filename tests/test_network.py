"""The network: gradient, learning, repeatability, stopping, saving."""
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from tabulark.ml import models as M
from tabulark.ml import network as NN


def frame(spark, x, y):
    df = spark.createDataFrame([(i, [float(v) for v in r], float(c)) for i, (r, c) in enumerate(zip(x, y))], "id long, v array<double>, label double")
    return df.select("id", array_to_vector("v").alias("features"), "label").repartition(4, "id").sortWithinPartitions("id")


def moons(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    return x, ((x ** 2).sum(1) > 1.2).astype(int) + ((x ** 2).sum(1) > 3)


def test_gradient_equals_differences():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(9, 3)), rng.integers(0, 4, 9)
    w = NN.first_weights(3, 5, 4, 1)
    _, g = NN.gradient(w, x, y, 3, 5, 4, 0.1)
    for i in range(0, len(w), 3):
        e = np.zeros(len(w))
        e[i] = 1e-6
        a, b = (NN.gradient(w + s * e, x, y, 3, 5, 4, 0.1)[0] for s in (1, -1))
        assert abs((a - b) / 2e-6 - g[i]) < 1e-6


def test_learns_repeats_and_saves(spark, tmp_path):
    x, y = moons(2000, 1)
    train = frame(spark, x, y)
    f = M.fit_mlp(train, 3, max_iter=60, batch=50, rate=0.01)
    losses = f.extra["losses"]
    assert losses[-1] < 0.35 * losses[0]
    fx, fy = moons(500, 2)
    test = frame(spark, fx, fy)
    out = M.predict(f, test).orderBy("id").collect()
    assert np.mean([r.prediction == r.label for r in out]) > 0.93 and all(abs(sum(r.probability) - 1) < 1e-9 for r in out)
    assert np.allclose(M.fit_mlp(train, 3, max_iter=60, batch=50, rate=0.01).extra["weights"], f.extra["weights"])
    M.save_fitted(f, f"{tmp_path}/net")
    again = M.predict(M.load_fitted(spark, f"{tmp_path}/net"), test).orderBy("id").collect()
    assert np.allclose([r.probability for r in again], [r.probability for r in out])


def test_stops_early_and_adds_up_in_tasks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    train = frame(spark, rng.normal(size=(400, 2)), rng.integers(0, 2, 400))
    one = M.fit_mlp(train, 2, max_iter=300, patience=3, tol=1e-3).extra
    assert len(one["losses"]) < 200
    monkeypatch.setattr(NN, "HIST_BYTES", 0)
    assert np.allclose(M.fit_mlp(train, 2, max_iter=300, patience=3, tol=1e-3).extra["weights"], one["weights"])
    with pytest.raises(ValueError):
        NN.fit_network(train.limit(0), 2)


def test_an_epoch_of_many_tasks_sends_one_sum(spark, monkeypatch):
    rng = np.random.default_rng(4)
    train = frame(spark, rng.normal(size=(400, 2)), rng.integers(0, 2, 400)).repartition(40, "id")
    sent, old = [], NN.add_up
    monkeypatch.setattr(NN, "add_up", lambda *a, **k: sent.append(old(*a, **k)) or sent[-1])
    NN.fit_network(train, 2, hidden=800, max_epochs=2)
    assert len(sent) == 2 and sent[0].count() == 1
