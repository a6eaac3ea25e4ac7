from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest

from barsmith.llm.common import min_links, roots
from barsmith.llm.embed import Codes, embedding_components, levelled, reach, tile
from barsmith.llm.topk import add_slices, select, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, block int, n string"


def vectors(n=300, dim=24, seed=2):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, dim))
    v = base[rng.integers(0, len(base), n)] + rng.normal(size=(n, dim)) * rng.choice([0.0, 0.05, 0.25, 0.4], (n, 1))
    v = (v / 4).astype(np.float32)
    v[5], v[6] = v[4], v[4]
    return v


def frame(spark, v, extra=()):
    rows = [(i, [float(x) for x in r], 0, 1, "x") for i, r in enumerate(v)] + list(extra)
    return spark.createDataFrame(rows, SCHEMA)


ODD = [(900, None, 0, 1, "x"), (901, [], 0, 1, "x"), (902, [0.0] * 24, 0, 1, "x"), (903, [float("nan")] + [1.0] * 23, 0, 1, "x"),
       (904, [None] + [1.0] * 23, 0, 1, "x"), (905, [float("inf")] * 24, 0, 1, "x"), (906, [1.0, 2.0], 0, 1, "x")]


@pytest.mark.parametrize("rows", [40, 4096])
def test_components_match_brute_force(spark, rows):
    v = vectors()
    got = {r.vec_id: r for r in embedding_components(frame(spark, v, ODD), rows=rows).collect()}
    d = v.astype(np.float64)
    cos = d @ d.T / np.outer(np.linalg.norm(d, axis=1), np.linalg.norm(d, axis=1))
    link = cos >= 0.9
    np.fill_diagonal(link, False)
    parent = np.arange(len(v))
    min_links(*np.nonzero(link), parent)
    for i, root in enumerate(roots(parent)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (link[i].sum(), root, root == i)
    for i, *_ in ODD:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_bound_loses_no_pair():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(200, 8)) * rng.choice([1e-3, 1, 1e3], (200, 1))
    y = x + rng.normal(size=x.shape) * np.abs(x).mean() * 0.2
    for t in (0.5, 0.9, 0.99):
        cos = (x @ y.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
        got, certain = set(), 0
        for i, j, sure in tile(Codes.of(x), Codes.of(y), t, False):
            assert (cos[i[sure], j[sure]] >= t).all()
            linked = sure | reach(x, y, i, j, t)
            got |= set(zip(i[linked], j[linked]))
            certain += sure.sum()
        assert got == set(zip(*np.nonzero(cos >= t)))
        assert certain > len(got) / 2


def test_strips_and_long_vectors(monkeypatch):
    monkeypatch.setattr("barsmith.llm.embed.STRIP", 7)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6, 2500))
    y = x + rng.normal(size=x.shape) * 0.5
    cos = (x @ y.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
    strips = list(tile(Codes.of(x), Codes.of(y), 0.85, False))
    assert len(strips) == 6
    linked = [reach(x, y, i, j, 0.85) for i, j, _ in strips]
    got = {p for (i, j, _), k in zip(strips, linked) for p in zip(i[k], j[k])}
    assert got == set(zip(*np.nonzero(cos >= 0.85)))


def test_levelled_keeps_cosines():
    v = np.array([[1e300, -1e300], [3e-310, 4e-310], [0.75, 0.0]])
    u = levelled(v)
    assert np.isfinite((u * u).sum(axis=1)).all() and (np.abs(u).max(axis=1) >= 0.5).all()
    assert np.array_equal(u[2], v[2]) and u[0, 0] == -u[0, 1]


@pytest.mark.parametrize("rows", [2, 4096])
def test_cosine_at_the_threshold_links(spark, rows):
    # cosine 0.6 exactly: 3 / (1 * 5); just below: 2.9999 in place of 3
    df = frame(spark, [], [(1, [1.0, 0.0], 0, 1, "x"), (2, [3.0, 4.0], 0, 1, "x"), (3, [0.0, -1.0], 0, 1, "x"),
                           (4, [-4.0, -2.9999], 0, 1, "x"), (5, [1e30, 1e29], 0, 1, "x"), (6, [1e-30, 1e-31], 0, 1, "x")])
    got = sorted(tuple(r) for r in embedding_components(df, threshold=0.6, rows=rows).collect())
    assert got == [(1, 3, 1, True), (2, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 3, 1, False), (6, 3, 1, False)]


def test_null_id_repeats_and_empty(spark):
    df = frame(spark, [], [(3, [1.0, 0.0], 0, 1, "x"), (3, [1.0, 0.0], 0, 1, "x"), (None, [1.0, 0.0], 0, 1, "x")])
    got = sorted(map(tuple, embedding_components(df).collect()), key=str)
    assert got == [(3, 1, 3, True), (3, 1, 3, True), (None, 0, None, False)]
    assert embedding_components(df.limit(0)).count() == 0
    assert top_k(df.limit(0)).count() == 0


@pytest.mark.parametrize("rows,asked", [(50, 7), (32768, 256)])
def test_top_k_matches_brute_force(spark, rows, asked):
    v = vectors()
    got = {}
    for r in top_k(frame(spark, v, ODD[:6]), every=20, k=20, rows=rows, asked=asked).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    q = np.floor(64 * v.astype(np.float64)).astype(np.int64)
    score = q @ q.T
    assert set(got) == set(range(0, len(v), 20))
    for i in got:
        order = sorted((j for j in range(len(v)) if j != i), key=lambda j: (-score[i, j], j))[:20]
        assert sorted(got[i]) == [(r + 1, j, score[i, j]) for r, j in enumerate(order)]


def test_slices_sum_and_select():
    rng = np.random.default_rng(0)
    v = rng.integers(-8, 8, (64, 5))
    up = v + 8
    slices = np.stack([np.packbits(((up >> b) & 1).astype(np.uint8).T, axis=1, bitorder="little") for b in range(4)], axis=1).copy().view(np.uint64)
    q = np.array([3, -5, 0, 1, -1])
    total = add_slices(slices, q)
    got = sum((((s[0] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.int64) << w) for w, s in enumerate(total))
    want = (up * np.where(q > 0, q, 0)).sum(1) + ((15 - up) * np.where(q < 0, -q, 0)).sum(1)
    assert (got == want).all()
    sure, tied = select(total, np.array([2**64 - 1], np.uint64), 10)
    cut = np.sort(want)[-10]
    bits = lambda x: set(np.flatnonzero((x[0] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)))
    assert bits(sure) | bits(tied) >= set(np.flatnonzero(want > cut))
    assert len(bits(sure)) <= 10 <= len(bits(sure) | bits(tied))


def _brute_top(rows, every, k):
    """In integers of any length; each row a query and a candidate of its own."""
    floor = lambda x: Fraction(x) * 64 // 1
    rows = [(i, [floor(x) for x in v]) for i, v in rows]
    out = []
    for a, (i, v) in enumerate(rows):
        if i % every == 0:
            score = [(min(max(-sum(x * y for x, y in zip(v, w)), -(1 << 63) + 1), 1 << 63), j, b) for b, (j, w) in enumerate(rows) if b != a and len(w) == len(v)]
            out += [(i, r + 1, j, min(-s, (1 << 63) - 1)) for r, (s, j, _) in enumerate(sorted(score)[:k])]
    return sorted(out)


def test_top_k_fewer_rows_than_k_and_shared_id(spark):
    df = frame(spark, [], [(0, [1.0, 0.5], 0, 1, "x"), (0, [1.0, 0.5], 0, 1, "x"), (7, [-1.0, 0.25], 0, 1, "x"), (9, [1.0], 0, 1, "x")])
    assert sorted(tuple(r) for r in top_k(df).collect()) == [(0, 1, 0, 5120)] * 2 + [(0, 2, 7, 64 * -64 + 32 * 16)] * 2


@pytest.mark.parametrize("rows,asked", [(3, 2), (8192, 4096)])
def test_top_k_drops_no_row(spark, rows, asked):
    rng = np.random.default_rng(4)
    given = [(0, [3e6, 1.0]), (1, [0.5, 0.25]), (20, [1.0, 1.0]), (20, [-1.0, 2.0]), (40, [0.0, 1.0]), (3, [1e20, 1.0]), (60, [-1e20, 0.0]),
             (4, [2.0 ** 55, -1.0]), (5, [1e300, 0.0]), (80, [2.0 ** 54, 3.0]), (6, [-2.0 ** 57, -0.1]), (7, [float(2 ** 31), 0.015])]
    given += [(int(i), [float(x) for x in rng.normal(size=2) * 10.0 ** rng.integers(-2, 9)]) for i in rng.integers(100, 130, 40)]
    df = spark.createDataFrame([(i, v) for i, v in given], "vec_id long, embedding array<double>").repartition(3)
    got = sorted(tuple(r) for r in top_k(df, every=20, k=4, rows=rows, asked=asked).collect())
    assert got == _brute_top(given, 20, 4)
