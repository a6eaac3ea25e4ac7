import datetime as dt

from conftest import make_bars
from pyspark.sql import functions as F

from barsmith import operators as op
from barsmith.functions import classify_regime, regime_ordinal

IND_SCHEMA = ("ticker string, trade_date date, day_open double, day_close double, day_high double, "
              "day_low double, day_volume bigint, bar_count bigint, avg_volume double, rsi double, "
              "signal_regime string")


def _regimes(spark, cases):
    df = spark.createDataFrame(cases, "rsi double, v double, a double")
    return [r.g for r in df.select(classify_regime("rsi", "v", "a").alias("g")).collect()]


def test_regime_bounds(spark):
    assert _regimes(spark, [(30.0, 150.0, 100.0), (45.0, 150.0, 100.0), (55.0, 150.0, 100.0),
                            (70.0, 150.0, 100.0)]) == ["LEAN_BUY", "NEUTRAL", "NEUTRAL", "LEAN_SELL"]
    assert _regimes(spark, [(30.0, 160.0, 100.0), (45.0, 160.0, 100.0), (55.0, 160.0, 100.0),
                            (70.0, 160.0, 100.0)]) == ["LEAN_BUY", "NEUTRAL", "NEUTRAL", "LEAN_SELL"]


def test_regime_extremes_and_volume_surge(spark):
    assert _regimes(spark, [(29.9, 150.0, 100.0), (70.1, 150.0, 100.0)]) == ["BUY", "SELL"]
    assert _regimes(spark, [(29.9, 160.0, 100.0), (70.1, 160.0, 100.0)]) == ["STRONG_BUY", "STRONG_SELL"]
    assert _regimes(spark, [(50.0, 10.0, 100.0), (56.0, 10.0, 100.0), (44.0, 10.0, 100.0)]) == \
        ["NEUTRAL", "LEAN_SELL", "LEAN_BUY"]


def test_unknown_on_missing_inputs_or_zero_average(spark):
    assert _regimes(spark, [(50.0, 1.0, 0.0), (50.0, 1.0, None), (None, 1.0, 1.0), (50.0, None, 1.0)]) == \
        ["UNKNOWN"] * 4


def test_ordinal_default_for_unlisted_label(spark):
    df = spark.createDataFrame([("STRONG_BUY",), ("STRONG_SELL",), ("UNKNOWN",), (None,)], "signal_regime string")
    assert [r.o for r in df.select(regime_ordinal().alias("o")).collect()] == [0.0, 6.0, 3.0, 3.0]


def _ind(spark, rows):
    out = []
    for t, day, close, regime in rows:
        out.append((t, dt.date.fromisoformat(day), close, close, close, close, 10, 1, 10.0, 50.0, regime))
    return spark.createDataFrame(out, IND_SCHEMA)


def test_first_day_and_zero_previous_close(spark):
    ind = _ind(spark, [("A", "2024-01-04", 0.0, "NEUTRAL"), ("A", "2024-01-05", 5.0, "NEUTRAL"),
                       ("A", "2024-01-03", 2.0, "BUY")])
    rows = {r.trade_date.isoformat(): r for r in op.signal_report(ind).collect()}
    first = rows["2024-01-03"]
    assert first.prev_regime is None and first.prev_close is None and first.regime_changed is False
    assert first.day_return_pct is None
    assert rows["2024-01-04"].regime_changed is True and rows["2024-01-04"].day_return_pct == -100.0
    assert rows["2024-01-05"].day_return_pct is None and rows["2024-01-05"].regime_changed is False


def test_friday_to_monday_row_lag_vs_calendar_lag(spark):
    ind = _ind(spark, [("A", "2024-01-05", 1.0, "BUY"), ("A", "2024-01-08", 2.0, "SELL")])
    row = {r.trade_date.isoformat(): r for r in op.signal_report(ind).collect()}["2024-01-08"]
    cal = {r.trade_date.isoformat(): r for r in op.calendar_lag_report(ind).collect()}["2024-01-08"]
    assert row.prev_regime == "BUY" and row.regime_changed is True and row.day_return_pct == 100.0
    assert cal.prev_regime is None and cal.regime_changed is False and cal.day_return_pct is None
    missed = op.missed_transitions(ind).collect()
    assert [(m.trade_date.isoformat(), m.gap_days) for m in missed] == [("2024-01-08", 3)]
    counts = op.transition_counts(ind).collect()[0]
    assert (counts.row_lag_changes, counts.calendar_lag_changes, counts.missed) == (1, 0, 1)


def test_calendar_lag_of_several_days(spark):
    ind = _ind(spark, [("A", "2024-01-05", 1.0, "BUY"), ("A", "2024-01-08", 2.0, "SELL"),
                       ("A", "2024-01-09", 4.0, "SELL")])
    cal = {r.trade_date.isoformat(): r for r in op.calendar_lag_report(ind, days=3).collect()}
    assert cal["2024-01-08"].prev_regime == "BUY" and cal["2024-01-08"].regime_changed is True
    assert cal["2024-01-09"].prev_regime is None


def test_unknown_transitions_count_as_changes(spark):
    ind = _ind(spark, [("A", "2024-01-02", 1.0, "UNKNOWN"), ("A", "2024-01-03", 1.0, "BUY"),
                       ("A", "2024-01-04", 1.0, "UNKNOWN")])
    assert op.regime_change_count(op.signal_report(ind)).collect()[0].regime_changes == 2


def test_summary_skips_null_averages_and_fills_zero(spark):
    ind = _ind(spark, [("A", "2024-01-02", 1.0, "BUY")]).withColumn("rsi", F.lit(None).cast("double"))
    rep = op.signal_report(ind)
    s = op.signal_summary(rep).collect()[0]
    assert s.avg_rsi is None and s.avg_return is None and s.days == 1
    f = op.signal_summary_filled(rep).collect()[0]
    assert f.avg_rsi == 0.0 and f.avg_return == 0.0 and f.total_volume == 10


def test_indicators_end_to_end_on_bars(spark):
    rows = []
    for d, vol in (("2024-01-02", 100), ("2024-01-03", 100), ("2024-01-04", 400)):
        closes = [10.0 + 0.1 * i for i in range(20)]
        for k, c in enumerate(closes):
            rows.append(("A", d, 570 + k, c - 0.1, c, vol))
    ind = op.indicators(make_bars(spark, rows)).orderBy("trade_date").collect()
    assert [r.rsi for r in ind] == [100.0, 100.0, 100.0]
    assert [r.signal_regime for r in ind] == ["SELL", "SELL", "STRONG_SELL"]
    assert ind[0].avg_volume == 4000.0
