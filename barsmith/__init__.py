"""barsmith: Spark-native analytics for time-ordered bar data.

Minute bars (ticker, trade_date, timestamp, open, high, low, close, volume)
roll up to daily OHLCV, an intraday Wilder RSI and a volume-aware regime,
day-over-day regime changes, ticker-pair correlations and the reports and
chart feeds built on them. Every operator is a ``DataFrame -> DataFrame``
function of built-in Spark expressions, windows, joins and aggregates.
"""

from . import constants, functions, operators, sources
from .operators import *  # noqa: F401,F403
from .sources import bars_from_events, read_bars, read_signals, verify_write, write_signals

__version__ = "0.1.0"
