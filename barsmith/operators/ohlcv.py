"""Daily roll-ups of bars: OHLCV, ordered close arrays, mean close."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequence import sequence_view

DAY_KEYS = ("ticker", "trade_date")
#: Closes of a page.
PAGE = 512


def ohlcv_aggregates(assume_unique_ts: bool = False) -> list[Column]:
    """The six OHLCV aggregate columns for a (ticker, trade_date) grouping.

    Open is the open of the earliest bar and close the close of the latest.
    By default the ordering key is the struct (timestamp, price), which
    defines both edge cases: equal timestamps resolve to the smaller open and
    the larger close, and a null timestamp sorts first. With
    ``assume_unique_ts`` the cheaper ``min_by``/``max_by`` pair is used
    (hash aggregate), valid when (ticker, timestamp) is unique.
    """
    if assume_unique_ts:
        edges = ["min_by(open, timestamp) AS day_open", "max_by(close, timestamp) AS day_close"]
    else:
        edges = ["min(named_struct('t', timestamp, 'p', open)).p AS day_open",
                 "max(named_struct('t', timestamp, 'p', close)).p AS day_close"]
    return [F.expr(e) for e in edges + [
        "max(high) AS day_high", "min(low) AS day_low",
        "sum(volume) AS day_volume", "count(1) AS bar_count",
    ]]


def daily_ohlcv(bars: DataFrame, assume_unique_ts: bool = False) -> DataFrame:
    """One row per (ticker, trade_date) with open, close, high, low, volume, bar_count.

    A single grouping: partial aggregation on the map side, so the shuffle
    carries one row per ticker-day per map task.
    """
    return bars.groupBy(*DAY_KEYS).agg(*ohlcv_aggregates(assume_unique_ts))


def ordered_closes(bars: DataFrame) -> DataFrame:
    """Daily rows with ``all_closes``: the day's non-null closes in time order.

    Elements are ordered by (timestamp, close). One array holds a ticker-day;
    ``close_pages`` bounds the arrays whatever the day's length.
    """
    return (
        bars.groupBy(*DAY_KEYS)
        .agg(F.expr("sort_array(collect_list(CASE WHEN close IS NOT NULL "
                    "THEN named_struct('t', timestamp, 'c', close) END)) AS pts"))
        .select(F.expr("ticker"), F.expr("trade_date"), F.expr("transform(pts, x -> x.c) AS all_closes"))
    )


def closes_digest(daily_closes: DataFrame) -> DataFrame:
    """Summary of each close array: length, first, last and sum (in array order)."""
    return daily_closes.select(
        F.expr("ticker"), F.expr("trade_date"),
        F.expr("CAST(size(all_closes) AS BIGINT) AS n_closes"),
        F.expr("get(all_closes, 0) AS first_close"),
        F.expr("get(all_closes, size(all_closes) - 1) AS last_close"),
        F.expr("aggregate(all_closes, 0D, (acc, x) -> acc + x) AS sum_closes"),
    )


def close_pages(bars: DataFrame, page: int = PAGE, split_minutes: int | None = None) -> DataFrame:
    """The day's non-null closes in time order, in pages of at most ``page`` of them.

    Rows (ticker, trade_date, page, offset, closes): pages are numbered from 0
    and ``offset`` is the position of a page's first close in the day. With
    ``split_minutes`` positions come from the chunk offsets, so no task holds
    a whole day. A bar without a close is in no page; rows of a day's bars
    without one form a page null with an empty array, so that each day of the
    bars has a row.
    """
    no = f"CASE WHEN pos < n_closes THEN CAST(floor(pos / {int(page)}) AS INT) END"
    return (sequence_view(bars, split_minutes)
            .groupBy(F.expr("ticker"), F.expr("trade_date"), F.expr(f"{no} AS page"))
            .agg(F.expr("min(CASE WHEN pos < n_closes THEN pos END) AS offset"),
                 F.expr("transform(sort_array(collect_list(CASE WHEN pos < n_closes THEN named_struct('i', pos, 'c', close) END)), "
                        "x -> x.c) AS closes")))


def pages_digest(pages: DataFrame) -> DataFrame:
    """``closes_digest`` from pages: each page is summed where it lies, then the pages of a day are merged."""
    per_page = pages.select(
        F.expr("ticker"), F.expr("trade_date"), F.expr("page"), F.expr("CAST(size(closes) AS BIGINT) AS n"),
        F.expr("get(closes, 0) AS a"), F.expr("get(closes, size(closes) - 1) AS z"),
        F.expr("aggregate(closes, 0D, (acc, x) -> acc + x) AS s"))
    return per_page.groupBy(*DAY_KEYS).agg(
        F.expr("sum(n) AS n_closes"), F.expr("min_by(a, page) AS first_close"),
        F.expr("max_by(z, page) AS last_close"), F.expr("sum(s) AS sum_closes"))


def daily_mean_close(bars: DataFrame) -> DataFrame:
    """Mean close per (ticker, trade_date) as ``avg_close``."""
    return bars.groupBy(*DAY_KEYS).agg(F.expr("avg(close) AS avg_close"))
