import random

import numpy as np
import pytest
from conftest import day_of, make_bars

from barsmith import operators as op


def _corr(spark, a, b, **kw):
    rows = day_of(a, ticker="A") + day_of(b, ticker="B")
    out = op.pair_correlation(make_bars(spark, rows), **kw).collect()
    assert len(out) == 1
    return out[0]


def test_min_points(spark):
    rng = random.Random(2)
    a = [rng.uniform(1, 2) for _ in range(10)]
    b = [x * 2 + rng.uniform(0, 0.1) for x in a]
    assert _corr(spark, a[:9], b[:9]).intraday_corr is None
    r = _corr(spark, a, b)
    assert r.common_points == 10
    assert r.intraday_corr == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-12)


def test_cut_to_shorter_day(spark):
    rng = random.Random(5)
    a = [rng.uniform(1, 2) for _ in range(12)]
    b = [rng.uniform(1, 2) for _ in range(20)]
    r = _corr(spark, a, b)
    assert r.common_points == 12
    assert r.intraday_corr == pytest.approx(np.corrcoef(a, b[:12])[0, 1], abs=1e-12)


def test_flat_series_is_null(spark):
    r = _corr(spark, [3.0] * 12, [float(i) for i in range(12)])
    assert r.intraday_corr is None


def test_zero_open_gives_null_return(spark):
    rows = [("A", "2024-01-02", 570, 0.0, 1.0, 1), ("B", "2024-01-02", 570, 2.0, 3.0, 1)]
    r = op.pair_correlation(make_bars(spark, rows)).collect()[0]
    assert r.return_a is None and r.return_b == pytest.approx(0.5) and r.return_diff is None
    assert r.intraday_corr is None and r.common_points == 1


def test_three_tickers_one_date(spark):
    rows = day_of([1.0, 2.0], ticker="C") + day_of([1.0, 2.0], ticker="A") + day_of([1.0, 2.0], ticker="B")
    daily = op.daily_ohlcv(make_bars(spark, rows))
    pairs = op.ticker_pairs(daily).collect()
    assert sorted((p.ticker_a, p.ticker_b) for p in pairs) == [("A", "B"), ("A", "C"), ("B", "C")]
    assert op.ticker_pairs(daily, ordered=True).count() == 6
    assert op.ticker_pairs(daily, strategy="merge").count() == 3
    assert op.pair_correlation(make_bars(spark, rows)).count() == 3


def test_single_ticker_has_no_pairs(spark):
    assert op.pair_correlation(make_bars(spark, day_of([1.0, 2.0, 3.0]))).count() == 0


def test_null_close_skipped_in_positions(spark):
    rng = random.Random(9)
    a = [rng.uniform(1, 2) for _ in range(12)]
    b = [rng.uniform(1, 2) for _ in range(12)]
    rows = day_of(a, ticker="A") + day_of(b, ticker="B")
    rows.append(("A", "2024-01-02", 560, 1.0, None, 1))   # earliest bar has no close
    r = op.pair_correlation(make_bars(spark, rows)).collect()[0]
    assert r.common_points == 12
    assert r.intraday_corr == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-12)


def test_strong_filter_summary_and_top(spark):
    rng = random.Random(4)
    rows = []
    for d in ("2024-01-02", "2024-01-03"):
        a = [rng.uniform(1, 2) for _ in range(15)]
        rows += day_of(a, ticker="A", day=d) + day_of([x + 1 for x in a], ticker="B", day=d)
        rows += day_of([-x for x in a], ticker="C", day=d)
    corr = op.pair_correlation(make_bars(spark, rows))
    strong = op.strong_pairs(corr).collect()
    assert sorted({(s.ticker_a, s.ticker_b) for s in strong}) == [("A", "B")]
    summ = op.pair_summary(corr).collect()
    assert len(summ) == 1 and summ[0].correlated_days == 2
    assert summ[0].avg_correlation == pytest.approx(1.0)
    assert op.top_pairs(op.pair_summary(corr), 1).count() == 1


def test_slot_returns_align_by_clock(spark):
    # A trades every minute; B misses minute 3. Slot returns still align by minute.
    a = [10.0, 11.0, 12.0, 11.5, 12.5, 13.0, 12.0, 12.2, 12.9, 13.5, 13.1, 14.0, 13.7]
    b = [x * 2 for x in a]
    rows = day_of(a, ticker="A") + [r for k, r in enumerate(day_of(b, ticker="B")) if k != 3]
    r = op.slot_return_corr(make_bars(spark, rows), slot_minutes=1, min_points=5).collect()[0]
    ra = {k: a[k] / a[k - 1] - 1 for k in range(1, len(a))}
    bb = {k: v for k, v in enumerate(b) if k != 3}
    keys = sorted(bb)
    rb = {k: bb[k] / bb[p] - 1 for p, k in zip(keys, keys[1:])}
    common = sorted(set(ra) & set(rb))
    assert r.common_slots == len(common)
    assert r.slot_corr == pytest.approx(np.corrcoef([ra[k] for k in common], [rb[k] for k in common])[0, 1],
                                        abs=1e-12)


def test_daily_close_corr_flat_is_null(spark):
    rows = []
    for i, d in enumerate(("2024-01-02", "2024-01-03", "2024-01-04")):
        rows += day_of([5.0], ticker="A", day=d) + day_of([float(i)], ticker="B", day=d)
        rows += day_of([float(2 * i)], ticker="C", day=d)
    got = {(r.ticker_a, r.ticker_b): r.correlation for r in op.daily_close_corr(make_bars(spark, rows)).collect()}
    assert got[("A", "B")] is None and got[("B", "C")] == pytest.approx(1.0)
    m = op.corr_matrix(make_bars(spark, rows)).collect()
    assert [r.ticker_a for r in m] == ["A", "B", "C"]
    assert m[1]["B"] == 1.0 and m[1]["C"] == pytest.approx(1.0)


@pytest.mark.parametrize("block", [1, 3, 7, 64, 4096])
def test_block_size_does_not_change_the_statistic(spark, block):
    rng = random.Random(13)
    rows = []
    series = {}
    for t in ("A", "B", "C"):
        n = {"A": 25, "B": 40, "C": 11}[t]
        xs = [100000.0 + round(rng.uniform(-50, 50), 2) for _ in range(n)]
        series[t] = xs
        rows += day_of(xs, ticker=t)
    got = {(r.ticker_a, r.ticker_b): (r.common_points, r.intraday_corr)
           for r in op.pair_correlation(make_bars(spark, rows), block=block).collect()}
    for a, b in (("A", "B"), ("A", "C"), ("B", "C")):
        n = min(len(series[a]), len(series[b]))
        assert got[(a, b)][0] == n
        assert got[(a, b)][1] == pytest.approx(np.corrcoef(series[a][:n], series[b][:n])[0, 1], abs=1e-9)


@pytest.mark.parametrize("block", [1, 5, 64])
def test_slot_corr_block_size_invariant(spark, block):
    rng = random.Random(21)
    a = [100 + rng.uniform(-1, 1) for _ in range(40)]
    b = [50 + rng.uniform(-1, 1) for _ in range(40)]
    rows = [r for k, r in enumerate(day_of(a, ticker="A")) if k % 7 != 3]
    rows += [r for k, r in enumerate(day_of(b, ticker="B")) if k % 5 != 2]
    base = op.slot_return_corr(make_bars(spark, rows), slot_minutes=1, min_points=5).collect()[0]
    got = op.slot_return_corr(make_bars(spark, rows).repartition(block), slot_minutes=1, min_points=5).collect()[0]
    assert got.common_slots == base.common_slots
    assert got.slot_corr == pytest.approx(base.slot_corr, abs=1e-12)


def test_corr_matrix_quoted_ticker_names(spark):
    rows = []
    for i, d in enumerate(("2024-01-02", "2024-01-03", "2024-01-04")):
        rows += day_of([float(i)], ticker="O'X", day=d) + day_of([float(3 * i + 1)], ticker="B`Q", day=d)
    m = {r.ticker_a: r for r in op.corr_matrix(make_bars(spark, rows)).collect()}
    assert m["O'X"]["O'X"] == 1.0 and m["B`Q"]["B`Q"] == 1.0
    assert m["O'X"]["B`Q"] == pytest.approx(1.0)


def test_slots_follow_a_session_over_midnight(spark):
    rows = []
    for ticker, base in (("A", 100.0), ("B", 50.0)):
        for i in range(6):  # 23:00 .. 01:30, each close 1 % above the one before
            rows.append((ticker, "2024-01-02", 23 * 60 + 30 * i, base, base * 1.01 ** i, 1))
    bars = make_bars(spark, rows)
    got = op.slot_returns(bars, slot_minutes=30).where("ticker = 'A'").orderBy("slot").collect()
    assert [r.slot for r in got] == [46, 47, 48, 49, 50, 51]
    assert [None if r.slot_return is None else round(r.slot_return, 6) for r in got] == [None] + [0.01] * 5


def test_absolute_threshold_keeps_strong_negatives(spark):
    df = spark.createDataFrame([("a", 0.9), ("b", -0.9), ("c", 0.1), ("d", None)], "t string, intraday_corr double")
    assert [r.t for r in op.strong_pairs(df).collect()] == ["a"]
    assert [r.t for r in op.strong_pairs(df, absolute=True).collect()] == ["a", "b"]
