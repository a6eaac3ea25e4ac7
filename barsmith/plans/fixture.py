"""The columns of the registered matrices: tickers and trading days of the test events.

Passed to both the Spark queries and their SQL twins. The events span
2024-01-01 .. 2024-01-30; weekend events belong to the following Monday.
"""

from __future__ import annotations

import datetime as _dt

TICKERS = ["click", "error", "purchase", "signup", "view"]
DATES = [d.isoformat() for d in (_dt.date(2024, 1, 1) + _dt.timedelta(i) for i in range(30)) if d.weekday() < 5]
#: The ticker of the one-ticker query.
TICKER = "view"
#: Trading days of the trailing average volume query.
TRAILING_DAYS = 5
