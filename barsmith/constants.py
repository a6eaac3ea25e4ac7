"""Fixed values that must equal the published pipeline's for equal results.

These are stated once, plainly, in natural order. Everything else in the
package takes them as default parameters so callers can vary them.
"""

# --- fixed values: indicator parameters -----------------------------------
RSI_PERIOD = 14                 # Wilder RSI look-back, in closes
OVERBOUGHT = 70.0               # rsi > 70 -> SELL family
OVERSOLD = 30.0                 # rsi < 30 -> BUY family
NEUTRAL_LOW = 45.0              # 45 <= rsi <= 55 -> NEUTRAL
NEUTRAL_HIGH = 55.0
VOLUME_SURGE = 1.5              # day_volume / avg_volume > 1.5 -> STRONG_*
MIN_CORR_POINTS = 10            # fewer common closes -> correlation is null
STRONG_CORR = 0.8               # intraday_corr > 0.8 -> strong pair
OUTPUT_FILES = 10               # files of the small report sink
TOP_PAIRS = 20                  # rows in the strong-pair preview
TOP_CHANGES = 30                # rows in the regime-change preview
OHLCV_FEED_TICKERS = 3          # top tickers by volume in the OHLCV feed
RSI_FEED_TICKERS = 4            # top tickers by volume in the RSI feed

# --- fixed values: regime labels ------------------------------------------
UNKNOWN = "UNKNOWN"
STRONG_SELL = "STRONG_SELL"
SELL = "SELL"
STRONG_BUY = "STRONG_BUY"
BUY = "BUY"
NEUTRAL = "NEUTRAL"
LEAN_SELL = "LEAN_SELL"
LEAN_BUY = "LEAN_BUY"

# Chart order of the regime labels; an unlisted label (UNKNOWN) maps to 3.
REGIME_ORDER = ["STRONG_BUY", "BUY", "LEAN_BUY", "NEUTRAL", "LEAN_SELL", "SELL", "STRONG_SELL"]
REGIME_ORDINAL_DEFAULT = 3

# RSI chart bands: oversold [0, 30], overbought [70, 100], mid line at 50.
RSI_BAND_OVERSOLD = "OVERSOLD"
RSI_BAND_OVERBOUGHT = "OVERBOUGHT"
RSI_BAND_MID = "MID"

# Candle direction: close >= open is UP.
UP = "UP"
DOWN = "DOWN"
