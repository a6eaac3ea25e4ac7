"""Load checks: row counts, ticker list, per-ticker bar and day counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: First day of the 32,768 days (to 2039-09-18) that a day bitmap covers; other days are kept as numbers.
FIRST_DAY = "1950-01-01"


def bar_count_total(bars: DataFrame) -> DataFrame:
    """One row with the number of bars."""
    return bars.agg(F.expr("count(1) AS total_rows"))


def distinct_tickers(bars: DataFrame) -> DataFrame:
    """The tickers present, one row each."""
    return bars.select(F.expr("ticker")).distinct()


def validate_bars(bars: DataFrame, ordered: bool = True, exact: bool = True) -> DataFrame:
    """Per ticker: bar_count and the number of distinct trading days.

    Exact: counted in two steps, per ticker-day and then per ticker, so the
    distinct count is a plain partial/final aggregate: the first shuffle
    carries one partial row per ticker-day and map task, the second one row
    per ticker-day, however many bars a hot ticker holds. ``exact=False``
    uses one aggregate with a HyperLogLog day count (one shuffle of
    per-task sketches; within a few percent).
    """
    if exact:
        per_day = bars.groupBy("ticker", "trade_date").agg(F.expr("count(1) AS n"))
        out = per_day.groupBy("ticker").agg(F.expr("sum(n) AS bar_count"), F.expr("count(1) AS day_count"))
    else:
        out = bars.groupBy("ticker").agg(F.expr("count(1) AS bar_count"),
                                         F.expr("approx_count_distinct(trade_date) AS day_count"))
    return out.orderBy("ticker") if ordered else out


def validate_daily(daily: DataFrame, ordered: bool = True) -> DataFrame:
    """``validate_bars`` from daily rows (one per ticker-day with ``bar_count``):
    the same table without touching the bars again."""
    out = daily.groupBy("ticker").agg(F.expr("sum(bar_count) AS bar_count"), F.expr("count(1) AS day_count"))
    return out.orderBy("ticker") if ordered else out


def day_bitmaps(bars: DataFrame) -> DataFrame:
    """Per ticker: bar_count and its trading days as a set that merges: ``days``, a bitmap of the 32,768 days from
    ``FIRST_DAY``, and ``far_days``, the numbers of days outside them.

    One aggregate by ticker, so one exchange, of a row per ticker and map
    task (the bitmap is 4 KB), however many bars or days there are. Bars
    without a date count as bars and have no day. Sets of several
    deliveries are united by ``merge_day_bitmaps``; days they share count once.
    """
    at = bars.selectExpr("ticker", f"datediff(trade_date, DATE'{FIRST_DAY}') AS at")
    return at.groupBy("ticker").agg(
        F.expr("count(1) AS bar_count"),
        F.expr("bitmap_construct_agg(CASE WHEN at BETWEEN 0 AND 32767 THEN CAST(at AS bigint) END) AS days"),
        F.expr("collect_set(CASE WHEN at NOT BETWEEN 0 AND 32767 THEN at END) AS far_days"))


def merge_day_bitmaps(sets: DataFrame) -> DataFrame:
    """One row per ticker from the ``day_bitmaps`` rows of any number of deliveries; merged sets merge again."""
    return sets.groupBy("ticker").agg(F.expr("sum(bar_count) AS bar_count"), F.expr("bitmap_or_agg(days) AS days"),
                                      F.expr("array_distinct(flatten(collect_set(far_days))) AS far_days"))


def validate_bitmaps(sets: DataFrame, ordered: bool = True) -> DataFrame:
    """``validate_bars`` from one ``day_bitmaps`` row per ticker, exact, without touching the bars again."""
    out = sets.select("ticker", "bar_count", F.expr("bitmap_count(days) + size(far_days) AS day_count"))
    return out.orderBy("ticker") if ordered else out
