import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barsmith.session import build_session  # noqa: E402

BAR_SCHEMA = ("ticker string, trade_date date, timestamp timestamp_ntz, open double, high double, "
              "low double, close double, volume bigint")


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=8, app_name="barsmith-tests",
                      spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="barsmith-test-warehouse-"))
    yield s


def make_bars(spark, rows):
    """rows: (ticker, 'YYYY-MM-DD', minute_of_day, open, close, volume) -> bar frame."""
    out = []
    for ticker, day, minute, o, c, v in rows:
        d = dt.date.fromisoformat(day)
        ts = dt.datetime.combine(d, dt.time()) + dt.timedelta(minutes=minute)
        hi = None if o is None or c is None else max(o, c)
        lo = None if o is None or c is None else min(o, c)
        out.append((ticker, d, ts, o, hi, lo, c, v))
    return spark.createDataFrame(out, BAR_SCHEMA)


def day_of(closes, ticker="AAA", day="2024-01-02", volume=100, start_minute=570):
    """Bars of one day whose closes are ``closes`` in time order; open = previous close."""
    rows = []
    prev = closes[0] if closes else None
    for k, c in enumerate(closes):
        rows.append((ticker, day, start_minute + k, prev, c, volume))
        prev = c
    return rows


def wilder_rsi(closes, period=14):
    """Textbook Wilder RSI of one close sequence, for cross-checks."""
    if closes is None or len(closes) < period + 1:
        return None
    diffs = [b - a for a, b in zip(closes, closes[1:])]
    gains = [d if d > 0 else 0.0 for d in diffs]
    losses = [-d if d <= 0 else 0.0 for d in diffs]
    ag = sum(gains[:period]) / period
    al = sum(losses[:period]) / period
    for g, l in zip(gains[period:], losses[period:]):
        ag = (ag * (period - 1) + g) / period
        al = (al * (period - 1) + l) / period
    if al == 0:
        return 100.0
    return 100.0 - 100.0 / (1.0 + ag / al)
