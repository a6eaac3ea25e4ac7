"""Bounds of intraday correlations, and strong pairs that only correlate what the bounds leave."""

import contextlib
import io
import random

import pytest
from conftest import day_of, make_bars

from barsmith import operators as op
from barsmith.session import stage


def _walks(seed=5):
    rng = random.Random(seed)
    rows, base = [], [0.0]
    for _ in range(400):
        base.append(base[-1] + rng.uniform(-1, 1))
    for d, day in enumerate(("2024-01-02", "2024-01-03", "2024-01-04")):
        for t in range(8):
            n = rng.choice([9, 40, 64, 65, 128, 200, 331, 331, 400])
            mix, c, closes = rng.uniform(-1.2, 1.2), 50.0 + t, []
            for i in range(n):
                c += rng.uniform(-0.4, 0.4)
                closes.append(round(c + mix * 10 * base[i], 3))
            rows += day_of(closes, ticker=f"T{t}", day=day, start_minute=300)
        rows += day_of([7.0] * 150, ticker="FLAT", day=day, start_minute=300)
        rows += day_of([7.0] * 100 + [8.0] * 100, ticker="STEP", day=day, start_minute=300)
        rows.append(("NONE", day, 300, 1.0, None, 5))
    return rows


def _key(r):
    return (r.ticker_a, r.ticker_b, r.trade_date)


@pytest.mark.parametrize("block", [64, 10, 3])
def test_every_coefficient_lies_within_its_bounds(spark, block):
    bars = make_bars(spark, _walks())
    corr = {_key(r): r.intraday_corr for r in op.pair_correlation(bars, min_points=2).collect()}
    blocks = stage(op.close_blocks(bars, block=block, summaries=True), "bounds")
    bounds = {_key(r): r for r in op.pair_bounds(blocks, block).collect()}
    known = 0
    for k, c in corr.items():
        if "NONE" in k:
            continue
        b = bounds[k]
        if c is not None and b.lower is not None:
            known += 1
            assert b.lower - 1e-9 <= c <= b.upper + 1e-9, (k, b, c)
    assert known > len(corr) // 4


@pytest.mark.parametrize("threshold,absolute", [(0.8, False), (0.8, True), (0.3, False), (-0.5, False)])
def test_strong_pairs_without_correlating_all(spark, threshold, absolute):
    bars = make_bars(spark, _walks(9))

    def rows(df):
        return sorted((tuple(round(v, 8) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)
    want = op.strong_pairs(op.pair_correlation(bars), threshold, absolute)
    got = op.strong_pair_days(bars, threshold, absolute)
    assert got.columns == want.columns
    want = rows(want)
    assert rows(got) == want and want


def test_bounds_prune_and_do_not_read_the_closes(spark):
    bars = make_bars(spark, _walks(3))
    blocks = stage(op.close_blocks(bars, summaries=True), "bounds")
    every, chosen = op.pair_bounds(blocks, 64), op.candidate_pair_days(blocks, 64, 0.8)
    assert chosen.count() < 0.8 * every.count()
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        chosen.explain("formatted")
    schemas = [line for line in out.getvalue().splitlines() if line.startswith("ReadSchema")]
    assert schemas and not any("xs" in line for line in schemas)


def test_empty_bars(spark):
    bars = make_bars(spark, _walks(3)).limit(0)
    assert op.strong_pair_days(bars).count() == 0 and op.daily_close_corr(bars).count() == 0
