"""The periodic autoencoder: gradients against differences, training over partitions, checkpoints."""

import numpy as np

from cliploom.operators import autoencoder as A


def curves(n, size=11, seed=1):
    rng, t = np.random.default_rng(seed), np.linspace(-2, 2, size)
    f, p = rng.choice([0.25, 0.5], (n, 1, 1)), rng.uniform(0, 2 * np.pi, (n, 1, 1))
    return np.concatenate([np.sin(2 * np.pi * f * t + p), 0.5 * np.cos(2 * np.pi * f * t + p)], axis=1)


def test_gradients():
    x = curves(5) + np.random.default_rng(0).normal(0, 0.1, (5, 2, 11))
    model = A.Autoencoder.random(2, (3,), 2, 11, 4.0, 3)
    grads = {}
    model.loss(x, grads)
    assert grads.keys() == model.weights.keys()
    rng = np.random.default_rng(2)
    for k, g in grads.items():
        for _ in range(3):
            at, old = tuple(rng.integers(0, s) for s in g.shape), None
            old = model.weights[k][at]
            ends = []
            for e in (1e-5, -1e-5):
                model.weights[k][at] = old + e
                ends.append(model.loss(x, {}))
            model.weights[k][at] = old
            assert abs((ends[0] - ends[1]) / 2e-5 - g[at]) < 1e-6 + 1e-4 * abs(g[at]), k


def test_training_over_partitions(spark):
    x = curves(600)
    df = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in x], "a array<double>, b array<double>")
    out = A.fit(df, ["a", "b"], A.Autoencoder.random(2, (6,), 3, 11, 4.0, 5), epochs=12, rate=0.02, batch=32, workers=2)
    assert len(out.losses) == 12 and out.losses[-1] < 0.5 * out.losses[0]
    again = A.Training.from_json(out.to_json())
    assert abs(again.model.loss(x) - out.model.loss(x)) < 1e-12
    assert len(A.fit(df, ["a", "b"], again, epochs=1, rate=1e-3, batch=32, workers=2).losses) == 13
    amp, freq, _ = out.model.encoder().parameters(x)
    assert amp.shape == freq.shape == (600, 3)
    assert A.fit(df.limit(0), ["a", "b"], again, epochs=2).losses == out.losses


def test_rates():
    rates = [A.one_cycle(e, 10, 1.0) for e in range(11)]
    assert rates[0] == 1 / 25 and max(rates) == rates[3] and rates[-1] < 1e-5
