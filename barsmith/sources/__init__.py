"""Sources and sinks: bar tables, the events mapping, report tables."""

from .bars import (BAR_COLUMNS, bars_from_events, enforce_bar_types, fixture_bars,
                   load_table, null_key, null_key_rows, read_bars, write_bar_table)
from .tables import read_signals, verify_write, write_signals

__all__ = [
    "BAR_COLUMNS", "bars_from_events", "enforce_bar_types", "fixture_bars", "load_table",
    "null_key", "null_key_rows", "read_bars", "read_signals", "verify_write", "write_bar_table",
    "write_signals",
]
