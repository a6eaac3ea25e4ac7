"""Column-level functions (built-in expressions only, no Python UDFs)."""

from .regime import candle_direction, classify_regime, regime_ordinal, rsi_band

__all__ = ["candle_direction", "classify_regime", "regime_ordinal", "rsi_band"]
