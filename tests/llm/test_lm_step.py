"""A training step is the plain gradient step, also where words share a neighbour, and sorts nothing."""

from __future__ import annotations

import numpy as np

from medloom.llm import lm


def plain_step(p, context, target, rate):
    x = p["embed"][context].reshape(len(context), -1)
    h = np.tanh(x @ p["w1"] + p["b1"])
    z = np.exp(h @ p["w2"] + p["b2"])
    d = z / z.sum(axis=1, keepdims=True)
    d[np.arange(len(target)), target] -= 1
    d /= len(target)
    dh = (d @ p["w2"].T) * (1 - h * h)
    dx = (dh @ p["w1"].T).reshape(len(context), 2 * lm.SIDE, lm.WIDTH)
    p["w2"] -= rate * (h.T @ d)
    p["b2"] -= rate * d.sum(axis=0)
    p["w1"] -= rate * (x.T @ dh)
    p["b1"] -= rate * dh.sum(axis=0)
    for word in range(len(context)):
        for k, row in enumerate(context[word]):
            p["embed"][row] -= rate * 8 * dx[word, k]


def test_step_is_the_gradient(monkeypatch):
    rng = np.random.default_rng(5)
    start = lm.initial()
    got, want = start.copy(), start.astype(np.float64)
    steps = [(rng.integers(0, 9, (n, 2 * lm.SIDE)), rng.integers(0, lm.CLASSES, n)) for n in (1, 7, 256)]
    steps.append((np.full((5, 2 * lm.SIDE), lm.INPUTS), np.zeros(5, np.int64)))
    sorts = []
    argsort = np.argsort
    monkeypatch.setattr(lm.np, "argsort", lambda *a, **k: sorts.append(1) or argsort(*a, **k))
    for context, target in steps:
        lm.train_step(lm._views(got), context, target, 0.2)
        plain_step(lm._views(want), context, target, 0.2)
    assert np.abs(got - start).max() > 0.01
    assert np.abs(got - want).max() < 1e-5
    assert not sorts


class Counted:
    """np.subtract whose ``at`` counts the places it is given."""

    def __init__(self, real):
        self.real, self.places = real, 0

    def at(self, a, indices, b):
        self.places += np.size(indices)
        self.real.at(a, indices, b)


def test_step_takes_two_parameters_at_a_place(monkeypatch):
    rng = np.random.default_rng(6)
    counted = Counted(np.subtract)
    monkeypatch.setattr(lm.np, "subtract", counted)
    context, target = rng.integers(0, 99, (256, 2 * lm.SIDE)), rng.integers(0, lm.CLASSES, 256)
    lm.train_step(lm._views(lm.initial()), context, target, 0.2)
    assert 0 < counted.places <= context.size * lm.WIDTH // 2


def test_wide_scores_are_shifted():
    rng = np.random.default_rng(7)
    start = lm.initial() * 60
    context, target = rng.integers(0, 99, (64, 2 * lm.SIDE)), rng.integers(0, lm.CLASSES, 64)
    p = lm._views(start)
    x = p["embed"][context].reshape(64, -1).astype(np.float64)
    z = np.tanh(x @ p["w1"] + p["b1"]) @ p["w2"] + p["b2"]
    assert z.max() > lm.WIDE
    z -= z.max(axis=1, keepdims=True)
    want = z[np.arange(64), target] - np.log(np.exp(z).sum(axis=1))
    assert np.allclose(lm.log_likelihood(p, context, target), want, rtol=1e-3, atol=1e-2)
    lm.train_step(p, context, target, 0.2)
    assert np.isfinite(start).all()
