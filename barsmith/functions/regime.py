"""Column expressions for regimes, bands and candle direction.

Arguments are column names or Spark SQL expressions; each function returns
one ``Column`` built from a single SQL expression (one JVM round trip).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _d(x: float) -> str:
    """A Spark SQL double literal."""
    return f"{float(x)!r}D"


def classify_regime_sql(rsi: str = "rsi", volume: str = "day_volume", avg_volume: str = "avg_volume",
                        overbought: float = K.OVERBOUGHT, oversold: float = K.OVERSOLD,
                        neutral_low: float = K.NEUTRAL_LOW, neutral_high: float = K.NEUTRAL_HIGH,
                        surge: float = K.VOLUME_SURGE) -> str:
    r, v, a = f"({rsi})", f"({volume})", f"({avg_volume})"
    surging = f"try_divide(CAST({v} AS DOUBLE), CAST({a} AS DOUBLE)) > {_d(surge)}"
    return (
        f"CASE WHEN {r} IS NULL OR {v} IS NULL OR {a} IS NULL THEN '{K.UNKNOWN}' "
        f"WHEN {a} = 0 THEN '{K.UNKNOWN}' "
        f"WHEN {r} > {_d(overbought)} AND {surging} THEN '{K.STRONG_SELL}' "
        f"WHEN {r} > {_d(overbought)} THEN '{K.SELL}' "
        f"WHEN {r} < {_d(oversold)} AND {surging} THEN '{K.STRONG_BUY}' "
        f"WHEN {r} < {_d(oversold)} THEN '{K.BUY}' "
        f"WHEN {r} >= {_d(neutral_low)} AND {r} <= {_d(neutral_high)} THEN '{K.NEUTRAL}' "
        f"WHEN {r} > {_d(neutral_high)} THEN '{K.LEAN_SELL}' "
        f"ELSE '{K.LEAN_BUY}' END"
    )


def classify_regime(rsi: str = "rsi", volume: str = "day_volume", avg_volume: str = "avg_volume",
                    **thresholds) -> Column:
    """Eight-way regime label from RSI and the day's volume ratio.

    Rules are tried in order; the first that holds wins. A null input or a
    zero average volume is UNKNOWN (the ratio is never divided by zero).
    Exactly 70 is LEAN_SELL, exactly 30 LEAN_BUY, 45 and 55 NEUTRAL, and a
    ratio of exactly 1.5 is not a surge.
    """
    return F.expr(classify_regime_sql(rsi, volume, avg_volume, **thresholds))


def regime_ordinal_sql(label: str = "signal_regime", order: list[str] | None = None,
                       default: int = K.REGIME_ORDINAL_DEFAULT) -> str:
    order = order or K.REGIME_ORDER
    whens = " ".join(f"WHEN '{name}' THEN CAST({i} AS DOUBLE)" for i, name in enumerate(order))
    return f"CASE ({label}) {whens} ELSE CAST({default} AS DOUBLE) END"


def regime_ordinal(label: str = "signal_regime", order: list[str] | None = None,
                   default: int = K.REGIME_ORDINAL_DEFAULT) -> Column:
    """Chart position of a label as double; labels outside ``order`` (and null) get ``default``."""
    return F.expr(regime_ordinal_sql(label, order, default))


def rsi_band(rsi: str = "rsi", overbought: float = K.OVERBOUGHT, oversold: float = K.OVERSOLD) -> Column:
    """OVERBOUGHT in [70, 100], OVERSOLD in [0, 30], MID between; null stays null."""
    return F.expr(f"CASE WHEN ({rsi}) IS NULL THEN CAST(NULL AS STRING) "
                  f"WHEN ({rsi}) >= {_d(overbought)} THEN '{K.RSI_BAND_OVERBOUGHT}' "
                  f"WHEN ({rsi}) <= {_d(oversold)} THEN '{K.RSI_BAND_OVERSOLD}' "
                  f"ELSE '{K.RSI_BAND_MID}' END")


def candle_direction(close: str = "day_close", open_: str = "day_open") -> Column:
    """UP when close >= open, else DOWN (a null price gives DOWN)."""
    return F.expr(f"CASE WHEN ({close}) >= ({open_}) THEN '{K.UP}' ELSE '{K.DOWN}' END")
