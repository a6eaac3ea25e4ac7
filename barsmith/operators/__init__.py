"""DataFrame -> DataFrame operators over bars and the daily report."""

from .bounds import candidate_pair_days, pair_bounds
from .feeds import (corr_matrix, date_dimension, grid_cells, ohlcv_feed, regime_grid, regime_matrix, rsi_feed,
                    top_tickers)
from .indicators import (avg_volume, daily_bars, indicators, with_avg_volume, with_avg_volume_window,
                         with_regime)
from .ohlcv import close_pages, closes_digest, daily_mean_close, daily_ohlcv, ordered_closes, pages_digest
from .pairs import (block_correlation, block_rows, close_blocks, daily_close_corr, intraday_returns, merge_day,
                    pair_correlation, pair_correlation_of, pair_summary, strong_pair_days, strong_pairs, ticker_pairs,
                    top_pairs)
from .report import (calendar_lag_report, missed_transitions, regime_change_count, regime_changes,
                     regime_timeline, signal_report, signal_summary, signal_summary_filled,
                     transition_counts)
from .rsi import intraday_rsi, rsi_of_array
from .sequence import close_points, sequence_view
from .slots import slot_return_corr, slot_returns
from .validate import (bar_count_total, day_bitmaps, distinct_tickers, merge_day_bitmaps, validate_bars,
                       validate_bitmaps, validate_daily)

__all__ = [
    "candidate_pair_days", "close_pages", "date_dimension", "grid_cells", "pages_digest", "pair_bounds", "regime_grid",
    "strong_pair_days", "avg_volume", "bar_count_total", "calendar_lag_report", "close_points", "closes_digest",
    "corr_matrix", "daily_bars", "daily_close_corr", "daily_mean_close", "daily_ohlcv",
    "distinct_tickers", "indicators", "intraday_returns", "intraday_rsi", "missed_transitions",
    "ohlcv_feed", "ordered_closes", "pair_correlation", "pair_summary", "regime_change_count",
    "regime_changes", "regime_matrix", "regime_timeline", "rsi_feed", "rsi_of_array",
    "sequence_view", "signal_report", "signal_summary", "signal_summary_filled", "slot_return_corr",
    "slot_returns", "strong_pairs", "ticker_pairs", "top_pairs", "top_tickers",
    "transition_counts", "validate_bars", "with_avg_volume", "with_avg_volume_window",
    "block_correlation", "block_rows", "close_blocks", "merge_day", "pair_correlation_of", "validate_daily", "with_regime",
    "day_bitmaps", "merge_day_bitmaps", "validate_bitmaps",
]
