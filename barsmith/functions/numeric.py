"""Null-safe arithmetic under ANSI mode, as SQL expressions over column names."""

from __future__ import annotations


def intraday_return_sql(close: str, open_: str) -> str:
    """(close - open) / open as a fraction; null when open is 0 or null."""
    return f"try_divide(({close}) - ({open_}), CASE WHEN ({open_}) <> 0 THEN ({open_}) END)"


def pct_change_sql(current: str, previous: str, scale: int = 2) -> str:
    """Percent change rounded to ``scale`` places; null if previous is null or 0."""
    return (f"CASE WHEN ({previous}) IS NOT NULL AND ({previous}) <> 0 "
            f"THEN round((({current}) - ({previous})) / ({previous}) * 100, {scale}) END")


def changed_sql(current: str, previous: str) -> str:
    """True only when both are present and differ."""
    return f"coalesce(({current}) <> ({previous}), false)"


def pearson_sql(x: str, y: str) -> str:
    """Population Pearson as an aggregate, null when a side is flat (``corr`` raises there under ANSI)."""
    den = f"(stddev_pop({x}) * stddev_pop({y}))"
    return f"try_divide(covar_pop({x}, {y}), CASE WHEN {den} <> 0 THEN {den} END)"
