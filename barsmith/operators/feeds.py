"""Chart feeds: top tickers by volume, per-ticker OHLCV and RSI series, matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import OHLCV_FEED_TICKERS, RSI_FEED_TICKERS
from ..functions.regime import candle_direction, regime_ordinal_sql, rsi_band
from .pairs import daily_close_corr


BROADCAST_TICKERS = 100_000  # longest ticker list that is broadcast


def top_tickers(report: DataFrame, k: int | None = None) -> DataFrame:
    """(ticker, total_vol) by summed day_volume, largest first, ties by ticker.

    With ``k`` only the first ``k`` are kept.
    """
    ranked = (report.groupBy("ticker").agg(F.expr("sum(day_volume) AS total_vol"))
              .orderBy(F.desc("total_vol"), "ticker"))
    return ranked if k is None else ranked.limit(k)


def _only_top(report: DataFrame, k: int) -> DataFrame:
    # The top-k list has at most k rows, so a small k is broadcast. The report is read
    # twice: pass a written or staged one.
    keep = top_tickers(report, k).select(F.expr("ticker"))
    return report.join(F.broadcast(keep) if k <= BROADCAST_TICKERS else keep, "ticker", "left_semi")


def ohlcv_feed(report: DataFrame, k: int = OHLCV_FEED_TICKERS) -> DataFrame:
    """Daily candles of the ``k`` largest tickers by volume, with UP/DOWN direction."""
    cols = ["ticker", "trade_date", "day_open", "day_high", "day_low", "day_close", "day_volume"]
    return (_only_top(report, k)
            .select(*[F.expr(c) for c in cols], candle_direction("day_close", "day_open").alias("direction"))
            .orderBy("ticker", "trade_date"))


def rsi_feed(report: DataFrame, k: int = RSI_FEED_TICKERS) -> DataFrame:
    """Daily RSI of the ``k`` largest tickers by volume, with its chart band."""
    return (_only_top(report, k)
            .select(F.expr("ticker"), F.expr("trade_date"), F.expr("rsi"), rsi_band("rsi").alias("rsi_band"))
            .orderBy("ticker", "trade_date"))


def regime_matrix(report: DataFrame, dates: Sequence[str] | None = None,
                  value: str = "ordinal") -> DataFrame:
    """Ticker x date matrix of regimes, one column per yyyy-MM-dd label.

    ``value="ordinal"`` gives the chart position as double (unknown labels
    3.0); ``value="label"`` gives the label text, "" where a ticker has no
    row that day. Pass ``dates`` to fix the columns and skip the distinct
    job: a date outside them is an error when the matrix is computed. Without
    it the dates present become the columns, up to Spark's limit of pivot
    values (``spark.sql.pivotMaxValues``); ``regime_grid`` has no such limit.
    """
    v = regime_ordinal_sql("signal_regime") if value == "ordinal" else "signal_regime"
    label = "date_format(trade_date, 'yyyy-MM-dd')"
    if dates is not None:
        label = _listed(label, dates, "date")
    long = report.select(F.expr("ticker"), F.expr(f"{label} AS date_label"), F.expr(f"{v} AS v"))
    grouped = long.groupBy("ticker")
    pivoted = (grouped.pivot("date_label", list(dates)) if dates is not None
               else grouped.pivot("date_label")).agg(F.expr("max(v)"))
    if value != "ordinal":
        pivoted = pivoted.na.fill("")
    return pivoted.orderBy("ticker")


def date_dimension(report: DataFrame) -> DataFrame:
    """(date_index, trade_date, date_label, n_dates): the dates of the report with dense indices from 0.

    One row per date of the calendar, however many tickers the report holds.
    """
    return report.select("trade_date").distinct().select(
        F.expr("CAST(row_number() OVER (ORDER BY trade_date) - 1 AS INT) AS date_index"), F.expr("trade_date"),
        F.expr("coalesce(date_format(trade_date, 'yyyy-MM-dd'), '') AS date_label"),
        F.expr("CAST(count(1) OVER () AS INT) AS n_dates"))


def regime_grid(report: DataFrame, dates: DataFrame, value: str = "ordinal") -> DataFrame:
    """(ticker, cells): one array per ticker with a cell per row of ``date_dimension``, in its order.

    The matrix without a column list: it spans whatever dates exist, and the
    schema does not depend on them. Each row brings the empty cells between
    the row before and itself, so an array is filled in one pass. ``value``
    and empty cells as in ``regime_matrix`` (null ordinals, "" labels).
    """
    v, kind, empty = ((regime_ordinal_sql("signal_regime"), "DOUBLE", "CAST(NULL AS DOUBLE)") if value == "ordinal"
                      else ("signal_regime", "STRING", "''"))
    index = dates.select(F.expr("date_index"), F.expr("trade_date AS _d"), F.expr("n_dates"))
    cells = (report.join(index, F.expr("trade_date <=> _d")).groupBy("ticker", "date_index")
             .agg(F.expr(f"CAST(max({v}) AS {kind}) AS v"), F.expr("max(n_dates) AS n_dates")))
    order = "OVER (PARTITION BY ticker ORDER BY date_index)"
    gaps = cells.select(
        F.expr("ticker"), F.expr("date_index"), F.expr("coalesce(v, " + empty + ") AS v"),
        F.expr(f"date_index - coalesce(lag(date_index) {order}, -1) - 1 AS gap"),
        F.expr(f"CASE WHEN lead(date_index) {order} IS NULL THEN n_dates - 1 - date_index ELSE 0 END AS tail"))
    part = f"concat(array_repeat({empty}, gap), array(v), array_repeat({empty}, tail))"
    return gaps.groupBy("ticker").agg(F.expr(
        f"flatten(transform(sort_array(collect_list(named_struct('i', date_index, 'c', {part}))), x -> x.c)) AS cells"))


def grid_cells(grid: DataFrame, dates: DataFrame) -> DataFrame:
    """(ticker, date_label, value): every cell of a ``regime_grid``, the empty ones too."""
    long = grid.select(F.expr("ticker"), F.expr("posexplode(cells) AS (i, value)"))
    return long.join(dates.select("date_index", "date_label"), F.expr("i = date_index")).select("ticker", "date_label", "value")


def _sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _listed(value: str, allowed: Sequence[str], what: str) -> str:
    """``value`` if it is in the list, else an error: a pivot would drop it without a word."""
    names = ", ".join(map(_sql_string, allowed))
    return (f"CASE WHEN {value} IN ({names}) THEN {value} "
            f"ELSE raise_error(concat('no column for {what} ', coalesce({value}, 'null'))) END") if allowed else (
            f"raise_error(concat('no column for {what} ', coalesce({value}, 'null')))")


def corr_matrix(bars: DataFrame, tickers: Sequence[str] | None = None,
                decimals: int | None = None) -> DataFrame:
    """Ticker x ticker matrix of daily-mean-close correlations, diagonal 1.0.

    Rows (``ticker_a``) and columns are ordered by ticker. ``decimals``
    rounds the cells as the chart annotations do. Ordered pairs are
    symmetric, so a ticker has a row exactly when it has a column; the
    diagonal is set after the pivot, with no second pass over the pairs. A
    ticker outside ``tickers`` is an error when the matrix is computed.
    """
    cells = daily_close_corr(bars, ordered=True)
    if tickers is not None:
        cells = cells.select(F.expr("ticker_a"), F.expr(_listed("ticker_b", tickers, "ticker") + " AS ticker_b"), F.expr("correlation"))
    if decimals is not None:
        cells = cells.select(F.expr("ticker_a"), F.expr("ticker_b"),
                             F.expr(f"round(correlation, {int(decimals)}) AS correlation"))
    grouped = cells.groupBy("ticker_a")
    names = sorted(tickers) if tickers is not None else None
    pivoted = (grouped.pivot("ticker_b", names) if names is not None
               else grouped.pivot("ticker_b")).agg(F.expr("max(correlation)"))
    if names is None:
        names = sorted(c for c in pivoted.columns if c != "ticker_a")
    diag = [F.expr(f"CASE WHEN ticker_a = {_sql_string(t)} THEN 1D ELSE `{t.replace('`', '``')}` END")
            .alias(t) for t in names]
    return pivoted.select(F.expr("ticker_a"), *diag).orderBy("ticker_a")
