"""Daily indicators: OHLCV, intraday RSI, average volume and the regime label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import RSI_PERIOD
from ..functions.regime import classify_regime_sql
from .ohlcv import ohlcv_aggregates
from .pairs import close_blocks, merge_day
from .rsi import rsi_aggregates, with_last_move
from .sequence import DAY_KEYS, sequence_view

DAILY_COLUMNS = ("ticker", "trade_date", "day_open", "day_close", "day_high", "day_low",
                 "day_volume", "bar_count")


def avg_volume(daily: DataFrame) -> DataFrame:
    """(ticker, avg_volume): mean day_volume over the ticker's whole history."""
    return daily.groupBy("ticker").agg(F.expr("avg(day_volume) AS avg_volume"))


def with_avg_volume(daily: DataFrame, strategy: str | None = None) -> DataFrame:
    """Attach ``avg_volume`` to daily rows by a left join on ticker.

    ``daily`` is read twice; stage it if it is not a table. ``strategy`` is an
    optional hint for this join ("merge", "shuffle_hash", "broadcast").

    No broadcast hint: the per-ticker side grows with the ticker count, so the
    choice is left to adaptive execution, which broadcasts it only when its
    measured size is under the broadcast threshold and sort-merges otherwise.
    """
    mean = avg_volume(daily)
    return daily.join(mean.hint(strategy) if strategy else mean, "ticker", "left")


def with_avg_volume_window(daily: DataFrame) -> DataFrame:
    """Same values as ``with_avg_volume`` as a window over ticker: one shuffle
    of the daily rows, no second scan, and the partitioning is shared with the
    day-over-day lags of the report."""
    return daily.select(F.expr("*"), F.expr("avg(day_volume) OVER (PARTITION BY ticker) AS avg_volume"))


def daily_bars(bars: DataFrame, period: int = RSI_PERIOD, split_minutes: int | None = None) -> DataFrame:
    """OHLCV and RSI per ticker-day from one shuffle of the bars.

    The sequence window partitions the bars by (ticker, trade_date); the
    aggregate on those keys reuses that partitioning and sort order. With
    ``split_minutes`` the windows run per day chunk, and the day is merged
    from blocks of positions (see ``rsi.compose_rsi``).
    """
    if split_minutes:
        return merge_day(close_blocks(bars, period, split_minutes=split_minutes, closes=False), period)
    return (with_last_move(sequence_view(bars)).groupBy(*DAY_KEYS)
            .agg(*ohlcv_aggregates(), *rsi_aggregates(period)))


def with_regime(daily: DataFrame, trailing_days: int | None = None, **regime_args) -> DataFrame:
    """Daily OHLCV + rsi rows -> the indicator table: adds avg_volume (window
    over the ticker's daily rows) and signal_regime, in the standard order.

    ``trailing_days=n`` averages the volume over the n trading days up to the
    row's own instead of the whole history (off by default: it changes the
    regimes).
    """
    frame = "" if trailing_days is None else f" ORDER BY trade_date ROWS BETWEEN {int(trailing_days) - 1} PRECEDING AND CURRENT ROW"
    return daily.select(
        *[F.expr(c) for c in DAILY_COLUMNS],
        F.expr(f"avg(day_volume) OVER (PARTITION BY ticker{frame}) AS avg_volume"),
        F.expr("rsi"),
    ).select(F.expr("*"), F.expr(classify_regime_sql(**regime_args) + " AS signal_regime"))


def indicators(bars: DataFrame, period: int = RSI_PERIOD, split_minutes: int | None = None, **regime_args) -> DataFrame:
    """Daily rows with avg_volume, rsi and signal_regime.

    Columns: ticker, trade_date, day_open, day_close, day_high, day_low,
    day_volume, bar_count, avg_volume, rsi, signal_regime.
    """
    return with_regime(daily_bars(bars, period, split_minutes), **regime_args)
