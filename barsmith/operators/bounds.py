"""Upper bounds of intraday correlations from block summaries.

A block of closes (centred on the day's first) is kept as its sum, its sum of
squares, its range and its coefficients in an orthonormal basis of four
vectors, the normalised indicators of its quarters. For two full blocks x, y
with coefficients u, v and residual norms rx, ry, by Cauchy and Schwarz

    u.v - rx ry <= x.y <= u.v + rx ry.

Correlation takes two days by position, cut to the shorter one. Let x be the
shorter day (n points, mean a), y the longer one, and let the first m points
be those in blocks full in both. The r = n - m points after them are x's last
block and the beginning of a block of y, whose values are within h of its
middle c. With y shifted by c,

    sum (x - a)(y - c) <= full part (its bound, shifted) + h sqrt(r q),

q the sum of squares of x - a over x's last block. It is the covariance's
numerator because x - a sums to zero. The squares of x are known; those of y
about its mean are at least those of the full part about its own. So the
quotient bounds a positive coefficient from above and a negative one from
below, from summaries alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Basis vectors of a block.
QUARTERS = 4
#: Relative allowance for rounding in the bound.
SLACK = 1e-6


def summary_aggregates(block: int) -> list[str]:
    """Aggregates over rows of ``sequence_view`` grouped by block: count, sum, squares, range, quarter sums."""
    x, has = "(close - first_close)", "pos < n_closes"
    quarter = f"((pos % {block}) * {QUARTERS}) DIV {block}"
    return [f"count(CASE WHEN {has} THEN 1 END) AS cnt", f"sum(CASE WHEN {has} THEN {x} END) AS s",
            f"sum(CASE WHEN {has} THEN {x} * {x} END) AS q", f"min(CASE WHEN {has} THEN {x} END) AS x_lo",
            f"max(CASE WHEN {has} THEN {x} END) AS x_hi",
            *[f"coalesce(sum(CASE WHEN {has} AND {quarter} = {j} THEN {x} END), 0D) AS w{j}" for j in range(QUARTERS)]]


def _quarter_sizes(block: int) -> list[int]:
    return [sum(1 for p in range(block) if p * QUARTERS // block == j) for j in range(QUARTERS)]


def _pairs(rows: DataFrame, keys: tuple[str, ...], columns: list[str]) -> DataFrame:
    a = rows.select(*[F.expr(f"{k} AS {k}") for k in keys], F.expr("ticker AS ticker_a"), *[F.expr(f"{c} AS {c}_a") for c in columns])
    b = rows.select(*[F.expr(f"{k} AS _{k}") for k in keys], F.expr("ticker AS ticker_b"), *[F.expr(f"{c} AS {c}_b") for c in columns])
    on = " AND ".join([f"{k} = _{k}" for k in keys] + ["ticker_a < ticker_b"])
    return a.join(b, F.expr(on)).drop(*[f"_{k}" for k in keys])


def pair_bounds(blocks: DataFrame, block: int) -> DataFrame:
    """(ticker_a, ticker_b, trade_date, lower, upper): bounds of the coefficient of every pair-day
    (lower at most 0, upper at least 0), null where nothing bounds it (a shorter day of less than one full block, or a flat side).

    ``blocks``: rows of ``close_blocks(..., summaries=True)``; their closes are not read.
    """
    keys = ("ticker_a", "ticker_b", "trade_date")
    w = [f"w{j}" for j in range(QUARTERS)]
    rows = blocks.where("blk IS NOT NULL AND cnt > 0").select("ticker", "trade_date", "blk", "cnt", "s", "q", "x_lo", "x_hi", *w)
    energy = " + ".join(f"{c} * {c} / {n}" for c, n in zip(w, _quarter_sizes(block)) if n)
    full = rows.where(f"cnt = {block}").select(
        "ticker", "trade_date", "blk", "s", "q", *w, F.expr(f"sqrt(greatest(q - ({energy}), 0D)) AS res"))
    dot = " + ".join(f"{c}_a * {c}_b / {n}" for c, n in zip(w, _quarter_sizes(block)) if n)
    parts = _pairs(full, ("trade_date", "blk"), ["s", "q", "res", *w]).groupBy(*keys).agg(
        F.expr(f"CAST(count(1) * {block} AS DOUBLE) AS m"), F.expr(f"sum({dot}) AS dot"), F.expr("sum(res_a * res_b) AS res"),
        *[F.expr(f"sum({c}_{side}) AS {c}f_{side}") for c in ("s", "q") for side in "ab"])
    days = rows.groupBy("ticker", "trade_date").agg(
        F.expr("CAST(sum(cnt) AS DOUBLE) AS n"), F.expr("sum(s) AS s"), F.expr("sum(q) AS q"),
        F.expr("max(named_struct('blk', blk, 'cnt', cnt, 's', s, 'q', q)) AS last"))
    pairs = _pairs(days, ("trade_date",), ["n", "s", "q", "last"]).join(parts, list(keys), "left")
    # x is the shorter day, y the longer one
    x = lambda c: f"CASE WHEN n_a <= n_b THEN {c}_a ELSE {c}_b END"
    y = lambda c: f"CASE WHEN n_a <= n_b THEN {c}_b ELSE {c}_a END"
    sides = pairs.select(
        *keys, "m", "dot", "res", F.expr(f"{y('ticker')} AS y"), F.expr(f"{x('n')} AS n"), F.expr(f"{x('s')} AS sx"), F.expr(f"{x('q')} AS qx"),
        F.expr(f"{x('last')} AS last"), F.expr(f"{x('sf')} AS sxf"), F.expr(f"{y('sf')} AS syf"), F.expr(f"{y('qf')} AS qyf"))
    edge = rows.select(F.expr("ticker AS _y"), F.expr("trade_date AS _d"), F.expr("blk AS _k"), F.expr("(x_lo + x_hi) / 2 AS c"), F.expr("(x_hi - x_lo) / 2 AS h"))
    met = sides.join(edge, F.expr("y = _y AND trade_date = _d AND last.blk = _k"), "left")
    rest = met.select(
        "*", F.expr("sx / n AS a"), F.expr("CASE WHEN n > m THEN c ELSE 0D END AS c0"),
        F.expr("CASE WHEN n > m THEN h * sqrt((n - m) * greatest(last.q - 2 * sx / n * last.s + sx / n * sx / n * last.cnt, 0D)) ELSE 0D END AS over"),
        F.expr("sqrt(greatest(qx - sx * sx / n, 0D) * greatest(qyf - syf * syf / m, 0D)) AS den"))
    middle = "(dot - c0 * sxf - a * syf + a * c0 * m)"
    # the squares of y may be larger than den's: it bounds a quotient away from zero, not towards it
    bound = lambda least, n: F.expr(f"CASE WHEN den > 0 THEN {least}(({middle} {n} (res + over)) / den, 0D) END")
    return rest.select(*keys, bound("least", "-").alias("lower"), bound("greatest", "+").alias("upper"))


def candidate_pair_days(blocks: DataFrame, block: int, threshold: float, absolute: bool = False) -> DataFrame:
    """(ticker_a, ticker_b, trade_date) whose coefficient may exceed ``threshold`` (``absolute``: in size)."""
    at = f"{float(threshold)!r}D - {SLACK}"
    maybe = f"lower IS NULL OR upper > {at}" + (f" OR lower < -({at})" if absolute else "")
    return pair_bounds(blocks, block).where(maybe).select("ticker_a", "ticker_b", "trade_date")
