"""The boosted tables against an independent slow version, row by row."""

from __future__ import annotations

import bisect
import math

import numpy as np
import pytest

from barsmith.llm.quality import Model


def slow_tree(g, h, leaves, ridge):
    part = lambda v, a, b: math.fsum(v[a:b])
    worth = lambda a, b: part(g, a, b) ** 2 / (part(h, a, b) + ridge)
    stretches = [(0, len(g))]
    while len(stretches) < leaves:
        best = None
        for a, b in stretches:
            for c in range(a + 1, b):
                gain = worth(a, c) + worth(c, b) - worth(a, b)
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-12):
                    best = gain, (a, b), c
        if best is None:
            break
        _, (a, b), c = best
        stretches.remove((a, b))
        stretches += [(a, c), (c, b)]
    out = [0.0] * len(g)
    for a, b in stretches:
        for i in range(a, b):
            out[i] = -part(g, a, b) / (part(h, a, b) + ridge)
    return out


def slow_scores(x, y, bins, rounds, pairs, pair_bins, rate, leaves, ridge):
    n, d = len(x), len(x[0])

    def cells(count):
        edges = [sorted({float(np.quantile([r[f] for r in x], k / count)) for k in range(1, count)}) for f in range(d)]
        return [[bisect.bisect_right(edges[f], r[f]) for r in x] for f in range(d)], [len(e) + 1 for e in edges]

    raw = [math.log((sum(y) + 1) / (n - sum(y) + 1))] * n

    def totals(at, size):
        g, h = [0.0] * size, [0.0] * size
        for i in range(n):
            p = 1 / (1 + math.exp(-raw[i]))
            g[at[i]] += p - y[i]
            h[at[i]] += p * (1 - p)
        return g, h

    at, size = cells(bins)
    for _ in range(rounds):
        for f in range(d):
            if size[f] > 1:
                step = slow_tree(*totals(at[f], size[f]), leaves, ridge)
                raw = [v + rate * step[c] for v, c in zip(raw, at[f])]
    at, size = cells(pair_bins)
    cross = {(a, b): [u * size[b] + v for u, v in zip(at[a], at[b])] for a in range(d) for b in range(a + 1, d)}
    gain = {}
    for (a, b), c in cross.items():
        g, h = totals(c, size[a] * size[b])
        gain[a, b] = sum(u * u / (v + ridge) for u, v in zip(g, h))
    chosen = sorted(gain, key=lambda k: (-gain[k], k))[:pairs]
    for _ in range(rounds // 4):
        for a, b in chosen:
            g, h = totals(cross[a, b], size[a] * size[b])
            step = []
            for i in range(size[a]):
                step += slow_tree(g[i * size[b]:(i + 1) * size[b]], h[i * size[b]:(i + 1) * size[b]], 2, ridge)
            raw = [v + rate * step[c] for v, c in zip(raw, cross[a, b])]
    return chosen, [1 / (1 + math.exp(-v)) for v in raw]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_tables_and_scores_equal_the_slow_version(seed):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(150, 4)), 2)
    x[:, 3] = rng.integers(0, 3, 150)  # few values: fewer bins than asked for
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(150) < 0.15)).astype(float)
    how = dict(bins=8, rounds=12, pairs=2, pair_bins=4, rate=0.2, leaves=4, ridge=2.0)
    model = Model(x, y, **how)
    chosen, want = slow_scores(x.tolist(), y.tolist(), **how)
    assert model.pairs == chosen and (0, 1) in chosen
    assert np.abs(model.score(x) - np.array(want)).max() < 1e-9


def test_one_label_or_no_rows_scores_the_smoothed_share():
    x = np.zeros((5, 20))
    assert np.allclose(Model(x, np.ones(5)).score(x), 6 / 7) and np.allclose(Model(x[:0], np.ones(0)).score(x), 0.5)
