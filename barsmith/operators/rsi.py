"""Intraday Wilder RSI without a UDF, at any length of the day.

Wilder smoothing seeds the average gain (loss) with the mean of the first
``p`` differences and then applies avg = r * avg + x / p, r = (p - 1) / p, for
each later difference. Each step is an affine map of the average, and affine
maps compose: a stretch of differences is one map avg -> r^k * avg + b, where b
sums the stretch's x / p, each decayed to the stretch's end. So partial sums
decayed to a common position merge by addition, and move to a later position
by a power of r.

Both averages decay alike, so RSI needs them at any one position: they are
taken at the last difference that moves (not at the day's end, where the
weights of a day with a long flat tail would all be zero). A whole day in one
task sums its rows there directly; a day in blocks composes block -> chapter ->
day (``compose_rsi``), where a chapter is a stretch short enough that no weight
in it underflows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import RSI_PERIOD
from .sequence import DAY_KEYS, sequence_view

#: A difference of rows of ``sequence_view``, and whether the row has one.
MOVE, HAS_MOVE = "(close - prev_close)", "pos >= 1 AND pos < n_closes"


def power_sql(period: int, n: str) -> str:
    """r to the ``n``-th, the decay over n differences."""
    return f"pow(CAST({period - 1} AS DOUBLE) / {period}, CAST({n} AS DOUBLE))"


def chapter_span(period: int) -> int:
    """Positions over which the decay stays above 1e-260."""
    return max(1, int(600 / -math.log((period - 1) / period))) if period > 1 else 1


def _least_average(period: int) -> int:
    """Where repeated smoothing of a positive double by zeros comes to rest, in units of the smallest double:
    the largest k that k * (p - 1) / p, rounded half to even, maps to itself."""
    half = period // 2
    return half - 1 if period % 2 == 0 and half % 2 else half


def rsi_from_sums_sql(gain: str, loss: str, n_diffs: str, period: int) -> str:
    """RSI from average gain and loss (or multiples of them): null below ``period`` differences,
    100 with no loss, else 100 - 100 / (1 + gain / loss)."""
    g, l = f"coalesce({gain}, 0D)", f"coalesce({loss}, 0D)"
    return (f"CASE WHEN coalesce({n_diffs}, 0) < {period} THEN CAST(NULL AS DOUBLE) "
            f"WHEN {l} = 0 THEN 100D ELSE 100D - 100D / (1D + {g} / {l}) END")


def partials_sql(period: int, end: str) -> dict[str, str]:
    """Aggregates over rows of ``sequence_view``: gains ``g`` and losses ``l`` decayed to position
    ``end`` (of the period or later), and the largest rise and fall (``up``, ``down``)."""
    w = power_sql(period, f"{end} - greatest(pos, {period})")
    return {
        "g": f"sum(CASE WHEN {HAS_MOVE} AND {MOVE} > 0 THEN {w} * {MOVE} END)",
        "l": f"sum(CASE WHEN {HAS_MOVE} AND {MOVE} < 0 THEN {w} * -{MOVE} END)",
        "up": f"max(CASE WHEN {HAS_MOVE} THEN {MOVE} END)",
        "down": f"max(CASE WHEN {HAS_MOVE} THEN -{MOVE} END)",
    }


def rsi_at_end_sql(g: str, l: str, up: str, down: str, end: str, n_closes: str, period: int) -> str:
    """RSI at the day's end from sums decayed to position ``end``.

    Step by step, an average that was ever positive stays positive: far below
    the range of doubles it rests at a few units of the smallest one, for gain
    and loss alike. The same holds here.
    """
    rest = f"CAST({_least_average(period)} * double('4.9E-324') AS DOUBLE)"
    decay = power_sql(period, f"{n_closes} - 1 - ({end})")

    def average(total: str, move: str) -> str:
        return f"greatest(coalesce({total}, 0D) * {decay} / {period}, CASE WHEN {move} > 0 THEN {rest} ELSE 0D END)"

    return rsi_from_sums_sql(average(g, up), average(l, down), f"{n_closes} - 1", period)


def with_last_move(seq: DataFrame) -> DataFrame:
    """Rows of ``sequence_view`` with ``last_move``: the position of the day's last difference that is not zero."""
    return seq.select(F.expr("*"), F.expr(f"max(CASE WHEN {HAS_MOVE} AND {MOVE} <> 0 THEN pos END) "
                                          "OVER (PARTITION BY ticker, trade_date) AS last_move"))


def rsi_aggregates(period: int = RSI_PERIOD) -> list[Column]:
    """Aggregate column ``rsi`` over rows of ``with_last_move`` grouped by ticker-day."""
    end = f"greatest(coalesce(last_move, 0), {period})"
    s = partials_sql(period, end)
    return [F.expr(rsi_at_end_sql(s["g"], s["l"], s["up"], s["down"], f"max({end})", "max(n_closes)", period) + " AS rsi")]


def rsi_blocks(seq: DataFrame, block: int, period: int = RSI_PERIOD, *extra: Column) -> DataFrame:
    """One row per (ticker, trade_date, ``blk`` of ``block`` positions): the block's map as ``g``, ``l``
    decayed to its end ``e``, with ``up``, ``down``, the day's ``n`` closes and the aggregates ``extra``.
    Rows without a close have a block of their own (null) or the last one."""
    end = f"greatest((CAST(floor(pos / {block}) AS BIGINT) + 1) * {block} - 1, {period})"
    sums = partials_sql(period, end)
    return seq.groupBy(F.expr("ticker"), F.expr("trade_date"), F.expr(f"CAST(floor(pos / {block}) AS INT) AS blk")).agg(
        *extra, *[F.expr(f"{x} AS {name}") for name, x in sums.items()],
        F.expr(f"max({end}) AS e"), F.expr("max(n_closes) AS n"))


def compose_rsi(blocks: DataFrame, period: int = RSI_PERIOD, extra: dict[str, str] | None = None,
                final: dict[str, str] | None = None) -> DataFrame:
    """Daily rows with ``rsi`` from rows of ``rsi_blocks``.

    Blocks are merged into chapters by an ordinary aggregate, whatever their
    number; the chapters of a day (one per thousands of closes) are decayed to
    the end of the last one that moves and merged. ``extra`` merges further
    columns of the blocks, ``final`` turns them into columns of the result.
    """
    span = chapter_span(period)
    extra, final = extra or {}, final or {}
    merge = [F.expr(f"{x} AS {name}") for name, x in extra.items()]
    chapters = blocks.withColumn("ch", F.expr(f"CASE WHEN blk IS NOT NULL THEN e DIV {span} END"))
    w = power_sql(period, f"(ch + 1) * {span} - 1 - e")
    chapters = chapters.groupBy("ticker", "trade_date", "ch").agg(
        *merge, F.expr(f"sum(g * {w}) AS g"), F.expr(f"sum(l * {w}) AS l"), F.expr("max(up) AS up"),
        F.expr("max(down) AS down"), F.expr("max(n) AS n"))
    day = "OVER (PARTITION BY ticker, trade_date)"
    chapters = chapters.select(F.expr("*"), F.expr(f"max(CASE WHEN g > 0 OR l > 0 THEN ch END) {day} AS top"))
    # chapters after the last one that moves hold nothing; a weight of theirs would overflow
    w = f"CASE WHEN ch <= top THEN {power_sql(period, f'(top - ch) * {span}')} END"
    rsi = rsi_at_end_sql(f"sum(g * {w})", f"sum(l * {w})", "max(up)", "max(down)", f"(coalesce(max(top), 0) + 1) * {span} - 1", "max(n)", period)
    return chapters.groupBy("ticker", "trade_date").agg(*merge, F.expr(f"{rsi} AS rsi")).select(
        "ticker", "trade_date", *[F.expr(f"{x} AS {name}") for name, x in final.items()], "rsi")


def intraday_rsi(bars: DataFrame, period: int = RSI_PERIOD, split_minutes: int | None = None, block: int = 64) -> DataFrame:
    """(ticker, trade_date, rsi): RSI of each day's closes in time order, restarting daily.

    A day is one task's rows, or with ``split_minutes`` blocks of ``block``
    closes that any number of tasks may hold; no array of closes is built.
    """
    seq = sequence_view(bars, split_minutes)
    if split_minutes:
        return compose_rsi(rsi_blocks(seq, block, period), period)
    return with_last_move(seq).groupBy(*DAY_KEYS).agg(*rsi_aggregates(period))


def rsi_of_array(closes: str, period: int = RSI_PERIOD) -> Column:
    """RSI of an ordered close array by the step-by-step recurrence.

    A fold with ``aggregate`` (JVM-side) for callers that hold the nested
    ``all_closes`` form; equal to ``intraday_rsi`` within float rounding. The state is
    (k closes seen, previous close, running gain, running loss); difference
    k sums until k = p, is divided by p at k = p, then smoothed.
    """
    p = f"CAST({period} AS DOUBLE)"
    gain = "CASE WHEN x - s.prev > 0 THEN x - s.prev ELSE 0D END"
    loss = "CASE WHEN x - s.prev > 0 THEN 0D ELSE s.prev - x END"

    def smooth(field: str, inc: str) -> str:
        return (f"CASE WHEN s.k = 0 THEN 0D WHEN s.k < {period} THEN s.{field} + {inc} "
                f"WHEN s.k = {period} THEN (s.{field} + {inc}) / {p} "
                f"ELSE (s.{field} * ({p} - 1) + {inc}) / {p} END")

    step = (f"(s, x) -> named_struct('k', s.k + 1, 'prev', x, "
            f"'g', {smooth('g', gain)}, 'l', {smooth('l', loss)})")
    finish = f"s -> {rsi_from_sums_sql('s.g', 's.l', 's.k - 1', period)}"
    start = "named_struct('k', 0, 'prev', CAST(NULL AS DOUBLE), 'g', 0D, 'l', 0D)"
    return F.expr(f"CASE WHEN ({closes}) IS NOT NULL THEN aggregate({closes}, {start}, {step}, {finish}) END")
