"""Day-over-day signal report, regime changes, calendar-day lag and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import changed_sql, pct_change_sql

# --- fixed names: columns of the report and the change feed ---
LAGGED = (("signal_regime", "prev_regime"), ("rsi", "prev_rsi"), ("day_close", "prev_close"))
CHANGE_COLUMNS = ("ticker", "trade_date", "prev_regime", "signal_regime", "rsi", "day_return_pct")

TRADING_DAYS = "PARTITION BY ticker ORDER BY trade_date"


def _calendar_days(days: int) -> str:
    # Exactly `days` calendar days back: a RANGE frame on the day number.
    return f"PARTITION BY ticker ORDER BY unix_date(trade_date) RANGE BETWEEN {days} PRECEDING AND {days} PRECEDING"


def _with_changes(df: DataFrame) -> DataFrame:
    return df.select(
        F.expr("*"),
        F.expr(changed_sql("signal_regime", "prev_regime") + " AS regime_changed"),
        F.expr(pct_change_sql("day_close", "prev_close") + " AS day_return_pct"),
    )


def signal_report(ind: DataFrame) -> DataFrame:
    """Indicators plus the previous *trading day's* regime, rsi and close.

    ``regime_changed`` is true only when both regimes are present and differ
    (UNKNOWN counts as a regime); the first day of a ticker has null prev_*
    values, no change and a null return. ``day_return_pct`` is the
    close-to-close change in percent, 2 places, null when the previous close
    is null or 0. One window over daily rows partitioned by ticker.
    """
    lags = [F.expr(f"lag({src}) OVER ({TRADING_DAYS}) AS {dst}") for src, dst in LAGGED]
    return _with_changes(ind.select(F.expr("*"), *lags))


def calendar_lag_report(ind: DataFrame, days: int = 1) -> DataFrame:
    """Like ``signal_report`` but the previous values come from exactly
    ``days`` calendar days earlier, null when that date has no row (so a
    Friday -> Monday step is not a change).

    Expressed as a RANGE frame [-days, -days] over the day number rather than
    a shifted self-join: same rows, no second scan and no join shuffle.
    """
    frame = _calendar_days(days)
    lags = [F.expr(f"first({src}) OVER ({frame}) AS {dst}") for src, dst in LAGGED]
    return _with_changes(ind.select(F.expr("*"), *lags))


def regime_changes(report: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows whose regime changed: six columns ordered by (trade_date, ticker)."""
    out = report.where("regime_changed").select(*[F.expr(c) for c in CHANGE_COLUMNS]).orderBy("trade_date", "ticker")
    return out.limit(limit) if limit is not None else out


def regime_change_count(report: DataFrame) -> DataFrame:
    """One row: number of regime changes."""
    return report.agg(F.expr("count_if(regime_changed) AS regime_changes"))


def _both_lags(ind: DataFrame, days: int) -> DataFrame:
    return ind.select(
        F.expr("*"),
        F.expr(f"lag(signal_regime) OVER ({TRADING_DAYS}) AS prev_regime"),
        F.expr(f"lag(trade_date) OVER ({TRADING_DAYS}) AS prev_date"),
        F.expr(f"first(signal_regime) OVER ({_calendar_days(days)}) AS cal_prev_regime"),
    )


def missed_transitions(ind: DataFrame, days: int = 1) -> DataFrame:
    """Changes seen with the trading-day lag but not with the calendar-day lag.

    Both lags come from one pass over the same ticker partitioning; no join.
    Columns: ticker, trade_date, prev_regime (previous trading day),
    signal_regime, gap_days (calendar days since the previous trading day).
    """
    return (_both_lags(ind, days)
            .where(f"{changed_sql('signal_regime', 'prev_regime')} "
                   f"AND NOT {changed_sql('signal_regime', 'cal_prev_regime')}")
            .select(F.expr("ticker"), F.expr("trade_date"), F.expr("prev_regime"), F.expr("signal_regime"),
                    F.expr("CAST(date_diff(trade_date, prev_date) AS INT) AS gap_days")))


def transition_counts(ind: DataFrame, days: int = 1) -> DataFrame:
    """One row: changes by trading-day lag, by calendar-day lag, and missed."""
    row = changed_sql("signal_regime", "prev_regime")
    cal = changed_sql("signal_regime", "cal_prev_regime")
    return _both_lags(ind, days).agg(
        F.expr(f"count_if({row}) AS row_lag_changes"),
        F.expr(f"count_if({cal}) AS calendar_lag_changes"),
        F.expr(f"count_if({row} AND NOT {cal}) AS missed"),
    )


def signal_summary(report: DataFrame) -> DataFrame:
    """Per (ticker, signal_regime): days, avg_rsi, avg_return, total_volume.
    Averages skip nulls (a regime with no RSI has a null avg_rsi)."""
    return report.groupBy("ticker", "signal_regime").agg(
        F.expr("count(1) AS days"),
        F.expr("avg(rsi) AS avg_rsi"),
        F.expr("avg(day_return_pct) AS avg_return"),
        F.expr("sum(day_volume) AS total_volume"),
    )


def signal_summary_filled(report: DataFrame) -> DataFrame:
    """``signal_summary`` with missing values shown as 0, ordered by (ticker, regime)."""
    return signal_summary(report).select(
        F.expr("ticker"), F.expr("signal_regime"), F.expr("days"),
        F.expr("coalesce(avg_rsi, 0D) AS avg_rsi"),
        F.expr("coalesce(avg_return, 0D) AS avg_return"),
        F.expr("coalesce(total_volume, 0) AS total_volume"),
    ).orderBy("ticker", "signal_regime")


def regime_timeline(report: DataFrame) -> DataFrame:
    """(ticker, trade_date, signal_regime, regime_changed) ordered by (trade_date, ticker)."""
    return (report.select(F.expr("ticker"), F.expr("trade_date"), F.expr("signal_regime"),
                          F.expr("regime_changed"))
            .orderBy("trade_date", "ticker"))
