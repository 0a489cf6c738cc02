"""Steps and scores of the language model: right slopes, and arrays that stay small."""

from __future__ import annotations

import numpy as np

from tallyward.llm import attention


def test_gradient_follows_the_loss():
    draw = np.random.default_rng(2)
    model = attention.Attention.fresh(20, 7)
    model.weights = {n: draw.standard_normal(v.shape) * 0.4 for n, v in model.weights.items()}  # 64 bits, for small differences
    x, y = draw.integers(0, 20, (6, 9)), draw.integers(0, 7, (6, 9))
    loss, found = model.gradient(x, y)
    assert np.isclose(loss, -model.log_share(x, y).mean())
    for name, slope in found.items():
        weight = model.weights[name]
        for _ in range(12):
            at = tuple(int(draw.integers(0, s)) for s in weight.shape)
            kept = weight[at]
            sides = []
            for weight[at] in (kept - 1e-4, kept + 1e-4):
                sides.append(-model.log_share(x, y).mean())
            weight[at] = kept
            assert np.isclose((sides[1] - sides[0]) / 2e-4, slope[at], rtol=1e-3, atol=1e-6), name


def test_few_windows_are_scored_at_once(monkeypatch):
    seen = []

    def log_share(self, x, y):
        seen.append(len(x))
        return np.zeros(x.shape, np.float32)

    monkeypatch.setattr(attention.Attention, "log_share", log_share)
    n, classes = attention.VOCABULARY, np.zeros(attention.VOCABULARY, np.int64)
    shares = attention.Shares(np.zeros(n), np.zeros((n + 1, attention.CLASSES)), np.ones((n + 1, attention.CLASSES)))
    texts = [np.arange(size) for size in (1, 5_000, 40, 9_000)]
    attention.text_scores(texts, attention.Attention.fresh(513), np.full(n, attention.OWN), classes, shares, np.empty(0, np.int64), np.empty(0, np.float32))
    assert sum(seen) == len(attention.windows(np.array([len(t) for t in texts]))[0]) and max(seen) <= 64
