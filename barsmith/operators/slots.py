"""Slot-aligned intraday return correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import MIN_CORR_POINTS
from .sequence import elapsed_minutes_sql
from .series import corr_sql


def slot_sql(bars: DataFrame, slot_minutes: int = 1) -> str:
    """Integer slot of the session: floor(minutes since the start of trade_date / slot_minutes).

    Minutes run on past midnight (and are negative before the trading day),
    so a session over midnight keeps its order.
    """
    return f"CAST(floor({elapsed_minutes_sql(bars, since='trade_date')} / {int(slot_minutes)}) AS INT)"


def slot_returns(bars: DataFrame, slot_minutes: int = 1) -> DataFrame:
    """(ticker, trade_date, slot, slot_close, slot_return) per occupied slot.

    slot_close is the last close in the slot by (timestamp, close), an
    aggregate on (ticker, trade_date, slot): combined map-side, so a hot
    ticker-day is reduced before any shuffle (and bars already partitioned by
    ticker-day need none). slot_return = slot_close / previous occupied
    slot's close - 1 within the day, null for the first slot or a zero
    previous close; that window runs over slot rows (at most 1,440 a
    calendar day).
    """
    last_in_slot = (
        bars.where("close IS NOT NULL")
        .groupBy(F.expr("ticker"), F.expr("trade_date"), F.expr(f"{slot_sql(bars, slot_minutes)} AS slot"))
        .agg(F.expr("max(named_struct('t', timestamp, 'c', close)).c AS close"))
    )
    prev = "lag(close) OVER (PARTITION BY ticker, trade_date ORDER BY slot)"
    return last_in_slot.select(
        F.expr("ticker"), F.expr("trade_date"), F.expr("slot"), F.expr("close AS slot_close"),
        F.expr(f"try_divide(close - {prev}, CASE WHEN {prev} <> 0 THEN {prev} END) AS slot_return"),
    )


def slot_return_corr(bars: DataFrame, slot_minutes: int = 1, min_points: int = MIN_CORR_POINTS) -> DataFrame:
    """Per (ticker_a < ticker_b, trade_date): correlation of slot returns.

    Returns are aligned by clock slot, not by position, so gaps in one
    ticker do not shift the other. Columns: ticker_a, ticker_b, trade_date,
    common_slots (at least 1), slot_corr (null below ``min_points`` or when
    flat). The slot rows join themselves on (trade_date, slot): a join group
    holds at most one row per ticker, only common slots come out, and both
    sides read one exchange. (Blocks of slots, as for positions, would be
    mostly empty: few of a day's minutes have a bar in both tickers.)
    """
    r = slot_returns(bars, slot_minutes).where("slot_return IS NOT NULL")
    a = r.select(F.expr("ticker AS ticker_a"), F.expr("trade_date"), F.expr("slot AS slot_a"), F.expr("slot_return AS x_a"))
    b = r.select(F.expr("ticker AS ticker_b"), F.expr("trade_date AS trade_date_b"), F.expr("slot AS slot_b"),
                 F.expr("slot_return AS x_b"))
    joined = a.join(b, F.expr("trade_date = trade_date_b AND slot_a = slot_b AND ticker_a < ticker_b"), "inner")
    return joined.groupBy("ticker_a", "ticker_b", "trade_date").agg(
        F.expr("count(1) AS common_slots"), F.expr(corr_sql(min_points) + " AS slot_corr"))
