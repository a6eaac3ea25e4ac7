"""Ticker pairs per day and their correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import MIN_CORR_POINTS, RSI_PERIOD, STRONG_CORR, TOP_PAIRS
from ..functions.numeric import intraday_return_sql, pearson_sql
from ..session import stage
from .rsi import compose_rsi, rsi_blocks
from .bounds import candidate_pair_days, summary_aggregates
from .ohlcv import daily_mean_close
from .sequence import sequence_view
from .series import DEFAULT_BLOCK, aligned_points, corr_sql

PAIR_FIELDS = (("day_open", "open"), ("day_close", "close"), ("day_volume", "volume"), ("rsi", "rsi"))


def _side(df: DataFrame, suffix: str, fields: Sequence[tuple[str, str]], date_name: str,
          extra: Sequence[str] = ()) -> DataFrame:
    return df.select(
        F.expr(f"ticker AS ticker_{suffix}"),
        F.expr(f"trade_date AS {date_name}"),
        *[F.expr(f"{src} AS {dst}_{suffix}") for src, dst in fields],
        *[F.expr(f"{c} AS {c}_{suffix}") for c in extra],
    )


def _pair_condition(ordered: bool, *equal: tuple[str, str]) -> str:
    cmp = "ticker_a <> ticker_b" if ordered else "ticker_a < ticker_b"
    return " AND ".join([f"{a} = {b}" for a, b in equal] + [cmp])


def ticker_pairs(daily: DataFrame, ordered: bool = False, strategy: str | None = None,
                 fields: Sequence[tuple[str, str]] = PAIR_FIELDS) -> DataFrame:
    """Pairs of tickers present on the same date.

    Unordered (``ticker_a < ticker_b``, C(n, 2) rows a day) by default, both
    directions with ``ordered=True``. The date is the equi-join key, so the
    join hashes on it and the ticker comparison is a residual filter; a join
    group is one date's tickers. ``strategy`` is an optional join hint
    ("merge", "shuffle_hash", "broadcast") applied to this join only.
    """
    fields = [f for f in fields if f[0] in daily.columns]
    a = _side(daily, "a", fields, "trade_date")
    b = _side(daily, "b", fields, "trade_date_b")
    if strategy:
        b = b.hint(strategy)
    joined = a.join(b, F.expr(_pair_condition(ordered, ("trade_date", "trade_date_b"))), "inner")
    return joined.select(*[F.expr(c) for c in ["ticker_a", "ticker_b", "trade_date"]
                           + [f"{d}_{s}" for s in ("a", "b") for _, d in fields]])


def intraday_returns(pairs: DataFrame) -> DataFrame:
    """Add open-to-close fractions ``return_a``, ``return_b`` and ``return_diff``
    (absolute gap); a zero open gives null instead of a division error."""
    ra, rb = intraday_return_sql("close_a", "open_a"), intraday_return_sql("close_b", "open_b")
    return pairs.select(F.expr("*"), F.expr(f"{ra} AS return_a"), F.expr(f"{rb} AS return_b"),
                        F.expr(f"abs(({ra}) - ({rb})) AS return_diff"))


#: Day fields of the blocks, as mergeable partials, and the daily columns they end in.
_DAY_PARTIALS = {"o": "min(o)", "c": "max(c)", "h": "max(h)", "lo": "min(lo)", "v": "sum(v)", "k": "sum(k)"}
_DAY_COLUMNS = {"day_open": "o.p", "day_close": "c.p", "day_high": "h", "day_low": "lo", "day_volume": "v", "bar_count": "k"}


def close_blocks(bars: DataFrame, period: int = RSI_PERIOD, block: int = DEFAULT_BLOCK,
                 split_minutes: int | None = None, closes: bool = True, summaries: bool = False) -> DataFrame:
    """One row per (ticker, trade_date, blk of ``block`` positions).

    ``xs``: the block's closes in order, centred on the day's first close (not
    with ``closes=False``); and the block's share of the day, as mergeable
    partials: earliest open and latest close as structs, high, low, volume,
    count, and the RSI's map (see ``rsi_blocks``). Bars without a close are in
    the last block or in one of their own (null ``blk``), with no ``xs``.
    ``summaries`` adds what bounds a block's share of a correlation (see
    ``bounds.summary_aggregates``).
    """
    more = summary_aggregates(block) if summaries else []
    xs = ("transform(sort_array(collect_list(CASE WHEN pos < n_closes "
          "THEN named_struct('i', pos, 'x', close - first_close) END)), e -> e.x) AS xs")
    day = ["min(named_struct('t', timestamp, 'p', open)) AS o", "max(named_struct('t', timestamp, 'p', close)) AS c",
           "max(high) AS h", "min(low) AS lo", "sum(volume) AS v", "count(1) AS k"]
    return rsi_blocks(sequence_view(bars, split_minutes), block, period, *[F.expr(e) for e in ([xs] if closes else []) + day + more])


def merge_day(blocks: DataFrame, period: int = RSI_PERIOD) -> DataFrame:
    """Daily OHLCV + rsi rows from the partials of ``close_blocks``; the blocks' closes are not read."""
    return compose_rsi(blocks, period, _DAY_PARTIALS, _DAY_COLUMNS)


def block_rows(blocks: DataFrame) -> DataFrame:
    """(ticker, trade_date, blk, xs) of the blocks that hold closes."""
    return blocks.where("blk IS NOT NULL AND size(xs) > 0").select(
        F.expr("ticker"), F.expr("trade_date"), F.expr("blk"), F.expr("xs"))


PAIR_KEYS = ("ticker_a", "ticker_b", "trade_date")


def block_correlation(blocks: DataFrame, min_points: int = MIN_CORR_POINTS) -> DataFrame:
    """(ticker_a < ticker_b, trade_date, common_points, intraday_corr) from rows of ``block_rows``.

    The blocks are joined to themselves on (trade_date, blk); both sides are
    the same rows, so the second reuses the first one's exchange, a join
    group holds at most one row per ticker, and adaptive execution splits a
    group with very many tickers. The joined blocks' points go into the
    covariance aggregates. Pairs without a common point have no row.
    """
    a = _side(blocks, "a", (), "trade_date", ["blk", "xs"])
    b = _side(blocks, "b", (), "trade_date_b", ["blk", "xs"])
    joined = a.join(b, F.expr(_pair_condition(False, ("trade_date", "trade_date_b"), ("blk_a", "blk_b"))), "inner")
    return aligned_points(joined, PAIR_KEYS).groupBy(*PAIR_KEYS).agg(
        F.expr("count(1) AS common_points"), F.expr(corr_sql(min_points) + " AS intraday_corr"))


def pair_correlation_of(daily: DataFrame, blocks: DataFrame, min_points: int = MIN_CORR_POINTS) -> DataFrame:
    """Pair correlation from daily rows and close blocks, e.g. two staged tables."""
    pairs = ticker_pairs(daily).join(block_correlation(blocks, min_points), list(PAIR_KEYS), "left")
    return intraday_returns(pairs.withColumn("common_points", F.expr("coalesce(common_points, 0L)")))


def pair_correlation(bars: DataFrame, daily: DataFrame | None = None,
                     min_points: int = MIN_CORR_POINTS, block: int = DEFAULT_BLOCK,
                     split_minutes: int | None = None, period: int = RSI_PERIOD, staged: bool = True) -> DataFrame:
    """Per (ticker_a < ticker_b, trade_date): intraday close correlation and returns.

    The correlation pairs the two days' closes by position in time order,
    cut to the shorter day, and is the population Pearson coefficient; null
    below ``min_points`` common positions or when either side is flat. The
    day fields (open, close, volume, rsi) come from ``daily`` when given (a
    staged indicator table), else from the blocks' day partials.

    The bars are read and shuffled once into blocks of ``block`` centred
    closes, written to the shared folder (``staged=False`` leaves them a plan,
    which is then run for the day rows and for the closes). A ticker with many
    bars adds blocks, not group size. No Python, and a block of positions
    travels as one row.
    """
    blocks = close_blocks(bars, period, block, split_minutes)
    if staged:
        blocks = stage(blocks, "blocks")
    return pair_correlation_of(merge_day(blocks, period) if daily is None else daily, block_rows(blocks), min_points)


def strong_pairs(correlated: DataFrame, threshold: float = STRONG_CORR, absolute: bool = False) -> DataFrame:
    """Pair-days with ``intraday_corr > threshold``; nulls drop out, and so do strong
    negatives unless ``absolute`` compares the coefficient's size."""
    corr = "abs(intraday_corr)" if absolute else "intraday_corr"
    return correlated.where(f"{corr} > {float(threshold)!r}D")


def strong_pair_days(bars: DataFrame, threshold: float = STRONG_CORR, absolute: bool = False,
                     min_points: int = MIN_CORR_POINTS, block: int = DEFAULT_BLOCK,
                     split_minutes: int | None = None, period: int = RSI_PERIOD) -> DataFrame:
    """``strong_pairs(pair_correlation(bars))`` without correlating every pair.

    Per-block summaries bound each pair-day's coefficient (``bounds``); only
    pair-days whose bound exceeds ``threshold`` read the closes and are
    correlated exactly. Same rows and columns.
    """
    blocks = stage(close_blocks(bars, period, block, split_minutes, summaries=True), "blocks")
    chosen = stage(candidate_pair_days(blocks, block, threshold, absolute), "candidates")
    return strong_pairs(candidate_correlation(merge_day(blocks, period), block_rows(blocks), chosen, min_points), threshold, absolute)


def candidate_correlation(daily: DataFrame, blocks: DataFrame, chosen: DataFrame, min_points: int = MIN_CORR_POINTS) -> DataFrame:
    """``pair_correlation`` of the pair-days in ``chosen`` (its keys) only, from daily rows and close blocks."""
    chosen = chosen.select(*PAIR_KEYS)
    a = _side(blocks, "a", (), "trade_date", ["blk", "xs"])
    b = _side(blocks, "b", (), "trade_date", ["blk", "xs"]).withColumnRenamed("blk_b", "blk_a")
    joined = chosen.join(a, ["ticker_a", "trade_date"]).join(b, ["ticker_b", "trade_date", "blk_a"])
    corr = aligned_points(joined, PAIR_KEYS).groupBy(*PAIR_KEYS).agg(
        F.expr("count(1) AS common_points"), F.expr(corr_sql(min_points) + " AS intraday_corr"))
    fields = [f for f in PAIR_FIELDS if f[0] in daily.columns]
    pairs = (chosen.join(_side(daily, "a", fields, "trade_date"), ["ticker_a", "trade_date"])
             .join(_side(daily, "b", fields, "trade_date"), ["ticker_b", "trade_date"]))
    names = list(PAIR_KEYS) + [f"{d}_{s}" for s in ("a", "b") for _, d in fields]
    return intraday_returns(pairs.select(*names).join(corr, list(PAIR_KEYS)))


def pair_summary(correlated: DataFrame, threshold: float = STRONG_CORR) -> DataFrame:
    """Per strong pair: correlated_days, avg_correlation, avg_return_diff."""
    return strong_pairs(correlated, threshold).groupBy("ticker_a", "ticker_b").agg(
        F.expr("count(1) AS correlated_days"),
        F.expr("avg(intraday_corr) AS avg_correlation"),
        F.expr("avg(return_diff) AS avg_return_diff"),
    )


def top_pairs(summary: DataFrame, n: int = TOP_PAIRS) -> DataFrame:
    """The ``n`` pairs with most strong days; ties broken by the tickers."""
    return summary.orderBy(F.desc("correlated_days"), "ticker_a", "ticker_b").limit(n)


#: Groups that tickers are dealt into, and days of a date range, of the correlation tiles.
TICKER_BUCKETS, RANGE_DAYS = 16, 512


def daily_close_corr(bars: DataFrame, ordered: bool = True, buckets: int = TICKER_BUCKETS) -> DataFrame:
    """Correlation across days of the daily mean close, per ticker pair.

    (ticker_a, ticker_b, correlation), both directions by default; null when
    a side is flat over the common days.

    A Gram matrix in tiles: tickers are dealt into ``buckets``, and a task
    holds one pair of buckets over one date range, whose co-moments collapse
    there before they are merged per pair. Only the triangle of bucket pairs
    is computed, each pair once; the other direction is mirrored at the end.
    A date's tickers never meet in one group: a tile's date has two arrays of
    about tickers / buckets closes.
    """
    daily = daily_mean_close(bars).where("ticker IS NOT NULL AND trade_date IS NOT NULL AND avg_close IS NOT NULL")
    packed = (daily.groupBy(F.expr("trade_date"), F.expr(f"CAST(pmod(xxhash64(ticker), {int(buckets)}) AS INT) AS bucket"))
              .agg(F.expr("collect_list(named_struct('ticker', ticker, 'x', avg_close)) AS xs")))
    tiles = (packed.select(F.expr("*"), F.expr(f"explode(sequence(0, {int(buckets) - 1})) AS other"))
             .select(F.expr("least(bucket, other) AS lo"), F.expr("greatest(bucket, other) AS hi"),
                     F.expr(f"unix_date(trade_date) DIV {RANGE_DAYS} AS dates"), F.expr("trade_date"), F.expr("bucket"), F.expr("xs"))
             .repartition("lo", "hi", "dates")
             .groupBy("lo", "hi", "dates", "trade_date")
             .agg(F.expr("first(CASE WHEN bucket = lo THEN xs END, true) AS xs_a"), F.expr("first(CASE WHEN bucket = hi THEN xs END, true) AS xs_b")))
    points = (tiles.select(F.expr("lo"), F.expr("hi"), F.expr("xs_b"), F.expr("inline(xs_a) AS (s, x)"))
              .select(F.expr("lo"), F.expr("hi"), F.expr("s"), F.expr("x"), F.expr("inline(xs_b) AS (t, y)"))
              .where("lo < hi OR s < t")
              .select(F.expr("least(s, t) AS ticker_a"), F.expr("greatest(s, t) AS ticker_b"),
                      F.expr("CASE WHEN s < t THEN x ELSE y END AS x"), F.expr("CASE WHEN s < t THEN y ELSE x END AS y")))
    once = points.groupBy("ticker_a", "ticker_b").agg(F.expr(pearson_sql("x", "y") + " AS correlation"))
    if not ordered:
        return once
    return once.select(F.expr("inline(array(named_struct('ticker_a', ticker_a, 'ticker_b', ticker_b, 'correlation', correlation), "
                              "named_struct('ticker_a', ticker_b, 'ticker_b', ticker_a, 'correlation', correlation)))"))
