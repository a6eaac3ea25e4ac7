"""Long-form intraday sequences: each bar with its position in the day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_KEYS = ("ticker", "trade_date")
LOWEST_CHUNK = -(1 << 40)  # the chunk of rows without a timestamp, below any real one

# Bars of one ticker-day ordered by (timestamp, close) with null closes last,
# so non-null closes take positions 0..n-1 and lag over them reaches the
# previous non-null close.
DAY_ORDER = "PARTITION BY ticker, trade_date ORDER BY close IS NULL, timestamp, close"


def elapsed_minutes_sql(df: DataFrame, ts: str = "timestamp", since: str | None = None) -> str:
    """Whole minutes up to ``ts``, counted from 1970 or from the start of the date ``since``.

    Grows with the timestamp across midnight and across clock changes: an
    instant (TIMESTAMP) is counted in elapsed time, a wall-clock TIMESTAMP_NTZ
    by its date and time of day.
    """
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        days = f"date_diff(CAST({ts} AS DATE), {since or "DATE'1970-01-01'"})"
        return f"(CAST({days} AS BIGINT) * 1440 + hour({ts}) * 60 + minute({ts}))"
    start = f" - unix_micros(CAST({since} AS TIMESTAMP))" if since else ""
    return f"CAST(floor((unix_micros({ts}){start}) / 60000000) AS BIGINT)"


def sequence_view(bars: DataFrame, split_minutes: int | None = None) -> DataFrame:
    """Bars plus ``pos`` (0-based among non-null closes), ``prev_close``, ``n_closes``
    and the day's ``first_close``.

    Default: one shuffle on (ticker, trade_date) and one sort; every window
    here shares it, and so does any aggregate on the same keys that follows.
    A ticker-day of minute bars is bounded (1,440 a calendar day).

    ``split_minutes=k`` is for series whose single days can be huge (tick
    data, a hot key): the bars are shuffled once by (ticker, trade_date,
    chunk of k minutes); chunk totals come from the rows so dealt and get
    their offsets and carried-over previous close from a window over the
    small chunk table, and the row windows run per chunk. Chunks follow the
    timestamp; rows without one form the lowest chunk, as they sort first.
    Same columns and values; one hot day becomes many tasks.

    Rows with a null close get a position at or beyond ``n_closes`` (default)
    or null (split); sequence consumers keep ``pos < n_closes``.
    """
    if not split_minutes:
        return bars.select(
            F.expr("*"),
            F.expr(f"row_number() OVER ({DAY_ORDER}) - 1 AS pos"),
            F.expr(f"lag(close) OVER ({DAY_ORDER}) AS prev_close"),
            F.expr("count(close) OVER (PARTITION BY ticker, trade_date) AS n_closes"),
            F.expr(f"first_value(close) OVER ({DAY_ORDER}) AS first_close"),
        )
    cols = bars.columns
    chunk = f"coalesce(floor({elapsed_minutes_sql(bars)} / {int(split_minutes)}), {LOWEST_CHUNK})"
    pts = (bars.select(F.expr("*"), F.expr(f"CAST({chunk} AS BIGINT) AS _chunk"))
           .repartition("ticker", "trade_date", "_chunk"))
    pt = "CASE WHEN close IS NOT NULL THEN named_struct('t', timestamp, 'c', close) END"
    before = "PARTITION BY ticker, trade_date ORDER BY _chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    chunks = (
        pts.groupBy("ticker", "trade_date", "_chunk")
        .agg(F.expr("count(close) AS _cnt"), F.expr(f"max({pt}).c AS _last"), F.expr(f"min({pt}).c AS _first"))
        .select(
            F.expr("ticker AS _t"), F.expr("trade_date AS _d"), F.expr("_chunk AS _k"),
            F.expr(f"coalesce(sum(_cnt) OVER ({before}), 0) AS _offset"),
            F.expr(f"last(_last, true) OVER ({before}) AS _carry"),
            F.expr("sum(_cnt) OVER (PARTITION BY ticker, trade_date) AS n_closes"),
            F.expr("first(_first, true) OVER (PARTITION BY ticker, trade_date ORDER BY _chunk "
                   "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_close"),
        )
    )
    order = "PARTITION BY ticker, trade_date, _chunk ORDER BY close IS NULL, timestamp, close"
    return (
        pts.join(chunks, F.expr("ticker <=> _t AND trade_date <=> _d AND _chunk = _k"), "inner")
        .select(
            *[F.expr(f"`{c}`") for c in cols],
            F.expr(f"CASE WHEN close IS NOT NULL THEN _offset + row_number() OVER ({order}) - 1 END AS pos"),
            F.expr(f"CASE WHEN close IS NOT NULL THEN coalesce(lag(close) OVER ({order}), _carry) END AS prev_close"),
            F.expr("n_closes"),
            F.expr("first_close"),
        )
    )


def close_points(bars: DataFrame, split_minutes: int | None = None) -> DataFrame:
    """(ticker, trade_date, pos, close, first_close) for the non-null closes only."""
    return (sequence_view(bars, split_minutes).where("pos < n_closes")
            .select(F.expr("ticker"), F.expr("trade_date"), F.expr("pos"), F.expr("close"),
                    F.expr("first_close")))
