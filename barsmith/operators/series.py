"""Blocks of aligned positions, and the correlation of the points in them.

A ticker-day's closes are cut into blocks of ``block`` consecutive positions,
one row with an array each (see ``pairs.close_blocks``). Two tickers' blocks
with the same (trade_date, blk) are aligned slot by slot, so one join row
carries up to ``block`` pairs of points. They are unfolded after the join and
feed the built-in covariance aggregates in the same stage, so a block's points
collapse into one partial result before the shuffle. Compared with joining one
row per position, the join itself handles ``block`` times fewer rows, while
every join group holds at most one row per ticker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import pearson_sql

DEFAULT_BLOCK = 64


def aligned_points(joined: DataFrame, keys: Sequence[str], xs_a: str = "xs_a", xs_b: str = "xs_b") -> DataFrame:
    """One row (*keys, x_a, x_b) per slot where both blocks of a joined row hold a value."""
    return (joined.select(*[F.expr(k) for k in keys], F.expr(f"inline(arrays_zip({xs_a}, {xs_b})) AS (x_a, x_b)"))
            .where("x_a IS NOT NULL AND x_b IS NOT NULL"))


def corr_sql(min_points: int, a: str = "x_a", b: str = "x_b") -> str:
    """Population Pearson of aligned points; null below ``min_points`` of them or when a
    side is flat. The aggregates merge centred moments, and partial results of a block
    collapse before the shuffle."""
    return f"CASE WHEN count(1) >= {min_points} THEN {pearson_sql(a, b)} END"
