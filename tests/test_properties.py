"""Property tests: random inputs against textbook definitions, order invariance."""

import random

import numpy as np
import pytest
from conftest import day_of, make_bars, wilder_rsi
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from barsmith import operators as op

prices = st.lists(st.sampled_from([99.5, 100.0, 100.25, 100.5, 101.0, 102.75]) | st.floats(50, 150),
                  min_size=0, max_size=60)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(prices, min_size=1, max_size=12), st.integers(2, 20))
def test_rsi_matches_recurrence(spark, days, period):
    rows, expect = [], {}
    for k, closes in enumerate(days):
        t = f"T{k}"
        rows += day_of(closes, ticker=t)
        expect[t] = wilder_rsi(closes, period)
    if not rows:
        return
    got = {r.ticker: r.rsi for r in op.intraday_rsi(make_bars(spark, rows), period=period).collect()}
    for t, v in expect.items():
        if t not in got:
            assert not days[int(t[1:])]
            continue
        if v is None:
            assert got[t] is None
        else:
            assert got[t] == pytest.approx(v, abs=1e-8)
            assert -1e-9 <= got[t] <= 100 + 1e-9


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000))
def test_daily_and_pairs_ignore_row_order_and_partitioning(spark, seed):
    rng = random.Random(seed)
    rows = []
    for t in ("A", "B", "C"):
        for d in ("2024-01-02", "2024-01-03"):
            rows += day_of([round(100 + rng.uniform(-2, 2), 2) for _ in range(rng.randint(5, 30))], ticker=t, day=d)
    shuffled = rows[:]
    rng.shuffle(shuffled)
    a, b = make_bars(spark, rows), make_bars(spark, shuffled).repartition(rng.randint(1, 7))
    assert sorted(op.daily_ohlcv(a).collect()) == sorted(op.daily_ohlcv(b).collect())
    pa = {(r.ticker_a, r.ticker_b, r.trade_date): r.intraday_corr for r in op.pair_correlation(a).collect()}
    pb = {(r.ticker_a, r.ticker_b, r.trade_date): r.intraday_corr for r in op.pair_correlation(b).collect()}
    assert pa.keys() == pb.keys()
    for k in pa:
        if pa[k] is None:
            assert pb[k] is None
        else:
            assert pb[k] == pytest.approx(pa[k], abs=1e-12)
            assert -1 - 1e-12 <= pa[k] <= 1 + 1e-12


def test_ohlc_bounds_on_fixture(spark):
    from barsmith.sources import fixture_bars
    d = op.daily_ohlcv(fixture_bars(spark, "/root/testdata/sf0.01"))
    bad = d.where("day_low > least(day_open, day_close) OR day_high < greatest(day_open, day_close) "
                  "OR day_low <= 0").count()
    assert bad == 0
    assert np.isfinite([r.day_close for r in d.collect()]).all()


def test_correlation_invariant_to_price_scale(spark):
    rng = random.Random(31)
    rows, scaled = [], []
    for t, k in (("A", 3.0), ("B", 0.25)):
        closes = [round(100 + rng.uniform(-4, 4), 2) for _ in range(30)]
        rows += day_of(closes, ticker=t)
        scaled += day_of([c * k for c in closes], ticker=t)
    a = op.pair_correlation(make_bars(spark, rows)).collect()[0].intraday_corr
    b = op.pair_correlation(make_bars(spark, scaled)).collect()[0].intraday_corr
    assert b == pytest.approx(a, abs=1e-9)


def test_calendar_changes_are_a_subset_of_row_changes(spark):
    from barsmith.sources import fixture_bars
    ind = op.indicators(fixture_bars(spark, "/root/testdata/sf0.01"))
    row = op.regime_changes(op.signal_report(ind)).select("ticker", "trade_date")
    cal = op.regime_changes(op.calendar_lag_report(ind)).select("ticker", "trade_date")
    assert cal.exceptAll(row).count() == 0
    assert row.count() - cal.count() == op.missed_transitions(ind).count() == 16
