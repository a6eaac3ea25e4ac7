"""SQL twins of the registered queries, for DuckDB over the same parquet tables.

Written independently of the Spark plans where SQL allows: the RSI twin is
the step-by-step Wilder recurrence as a recursive CTE, the calendar lag is
a shifted self-join, OHLC edges use ordered aggregates. Double columns are
rounded to 6 places, as the registered Spark queries are.
"""

from __future__ import annotations

from .. import constants as K
from . import fixture

DEC = 6

# The events -> bars mapping (DuckDB numbers weekdays 0 = Sunday .. 6 = Saturday).
BARS = """
minutes AS (
  SELECT event_type AS ticker,
         CAST(ts AS DATE) + CASE dayofweek(ts) WHEN 6 THEN 2 WHEN 0 THEN 1 ELSE 0 END AS trade_date,
         date_trunc('minute', ts) AS timestamp,
         CAST(sum(CAST(ROUND(value*100) AS BIGINT) - 5000) AS BIGINT) AS step,
         CAST(sum(CAST(ROUND(value*100) AS BIGINT)) AS BIGINT) AS cents
  FROM events GROUP BY ALL),
walk AS (
  SELECT *, 10000000 + SUM(step) OVER (
           PARTITION BY ticker ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c
  FROM minutes),
px AS (
  SELECT *, CAST(c - step AS DOUBLE)/100.0 AS open, CAST(c AS DOUBLE)/100.0 AS close FROM walk),
bars AS (
  SELECT ticker, CAST(trade_date AS DATE) AS trade_date, timestamp,
         open, GREATEST(open, close) AS high, LEAST(open, close) AS low, close,
         CAST(cents * CASE WHEN EXTRACT(DAY FROM trade_date) % 5 = 0 THEN 3 ELSE 1 END AS BIGINT) AS volume
  FROM px)"""

OHLCV = """
ohlcv AS (
  SELECT ticker, trade_date,
         first(open ORDER BY timestamp, open) AS day_open,
         last(close ORDER BY timestamp, close) AS day_close,
         max(high) AS day_high, min(low) AS day_low,
         CAST(sum(volume) AS BIGINT) AS day_volume, count(*) AS bar_count
  FROM bars GROUP BY ticker, trade_date)"""

P = K.RSI_PERIOD
RSI = f"""
seq AS (
  SELECT ticker, trade_date, timestamp, close,
         row_number() OVER (PARTITION BY ticker, trade_date ORDER BY timestamp, close) - 1 AS i
  FROM bars WHERE close IS NOT NULL),
rec(ticker, trade_date, k, prev, g, l) AS (
  SELECT ticker, trade_date, 1, close, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM seq WHERE i = 0
  UNION ALL
  SELECT r.ticker, r.trade_date, r.k + 1, s.close,
         CASE WHEN r.k < {P} THEN r.g + GREATEST(s.close - r.prev, 0)
              WHEN r.k = {P} THEN (r.g + GREATEST(s.close - r.prev, 0)) / CAST({P} AS DOUBLE)
              ELSE (r.g * CAST({P - 1} AS DOUBLE) + GREATEST(s.close - r.prev, 0)) / CAST({P} AS DOUBLE) END,
         CASE WHEN r.k < {P} THEN r.l + GREATEST(r.prev - s.close, 0)
              WHEN r.k = {P} THEN (r.l + GREATEST(r.prev - s.close, 0)) / CAST({P} AS DOUBLE)
              ELSE (r.l * CAST({P - 1} AS DOUBLE) + GREATEST(r.prev - s.close, 0)) / CAST({P} AS DOUBLE) END
  FROM rec r JOIN seq s ON s.ticker = r.ticker AND s.trade_date = r.trade_date AND s.i = r.k),
rsi_last AS (
  SELECT ticker, trade_date, arg_max(g, k) AS g, arg_max(l, k) AS l, max(k) - 1 AS n_diffs
  FROM rec GROUP BY ticker, trade_date),
rsi AS (
  SELECT o.ticker, o.trade_date,
         CASE WHEN r.n_diffs IS NULL OR r.n_diffs < {P} THEN CAST(NULL AS DOUBLE)
              WHEN r.l = 0 THEN 100.0
              ELSE 100.0 - 100.0 / (1.0 + r.g / r.l) END AS rsi
  FROM ohlcv o LEFT JOIN rsi_last r USING (ticker, trade_date))"""

REGIME = f"""CASE WHEN rsi IS NULL OR day_volume IS NULL OR avg_volume IS NULL THEN 'UNKNOWN'
              WHEN avg_volume = 0 THEN 'UNKNOWN'
              WHEN rsi > {K.OVERBOUGHT} AND day_volume / avg_volume > {K.VOLUME_SURGE} THEN 'STRONG_SELL'
              WHEN rsi > {K.OVERBOUGHT} THEN 'SELL'
              WHEN rsi < {K.OVERSOLD} AND day_volume / avg_volume > {K.VOLUME_SURGE} THEN 'STRONG_BUY'
              WHEN rsi < {K.OVERSOLD} THEN 'BUY'
              WHEN rsi >= {K.NEUTRAL_LOW} AND rsi <= {K.NEUTRAL_HIGH} THEN 'NEUTRAL'
              WHEN rsi > {K.NEUTRAL_HIGH} THEN 'LEAN_SELL'
              ELSE 'LEAN_BUY' END"""

def _ind(frame: str = "") -> str:
    return f"""
ind0 AS (
  SELECT o.*, avg(o.day_volume) OVER (PARTITION BY o.ticker{frame}) AS avg_volume, r.rsi
  FROM ohlcv o JOIN rsi r USING (ticker, trade_date)),
ind AS (
  SELECT ticker, trade_date, day_open, day_close, day_high, day_low, day_volume, bar_count,
         avg_volume, rsi, {REGIME} AS signal_regime
  FROM ind0)"""


IND = _ind()
IND_TRAILING = _ind(f" ORDER BY o.trade_date ROWS BETWEEN {fixture.TRAILING_DAYS - 1} PRECEDING AND CURRENT ROW")

REPORT = """
rep0 AS (
  SELECT *, lag(signal_regime) OVER w AS prev_regime, lag(rsi) OVER w AS prev_rsi,
         lag(day_close) OVER w AS prev_close
  FROM ind WINDOW w AS (PARTITION BY ticker ORDER BY trade_date)),
report AS (
  SELECT *, COALESCE(signal_regime <> prev_regime, false) AS regime_changed,
         CASE WHEN prev_close IS NOT NULL AND prev_close <> 0
              THEN ROUND((day_close - prev_close) / prev_close * 100, 2) END AS day_return_pct
  FROM rep0)"""

CALENDAR = """
cal0 AS (
  SELECT i.*, p.signal_regime AS prev_regime, p.rsi AS prev_rsi, p.day_close AS prev_close
  FROM ind i LEFT JOIN ind p ON p.ticker = i.ticker AND p.trade_date = i.trade_date - 1),
calendar AS (
  SELECT *, COALESCE(signal_regime <> prev_regime, false) AS regime_changed,
         CASE WHEN prev_close IS NOT NULL AND prev_close <> 0
              THEN ROUND((day_close - prev_close) / prev_close * 100, 2) END AS day_return_pct
  FROM cal0)"""

PAIRS = """
pairs AS (
  SELECT a.ticker AS ticker_a, b.ticker AS ticker_b, a.trade_date,
         a.day_open AS open_a, a.day_close AS close_a, a.day_volume AS volume_a, a.rsi AS rsi_a,
         b.day_open AS open_b, b.day_close AS close_b, b.day_volume AS volume_b, b.rsi AS rsi_b
  FROM ind a JOIN ind b ON a.trade_date = b.trade_date AND a.ticker < b.ticker),
returns AS (
  SELECT *, abs(return_a - return_b) AS return_diff FROM (
    SELECT *, CASE WHEN open_a <> 0 THEN (close_a - open_a) / open_a END AS return_a,
              CASE WHEN open_b <> 0 THEN (close_b - open_b) / open_b END AS return_b
    FROM pairs))"""

CORRELATED = f"""
cstats AS (
  SELECT a.ticker AS ticker_a, b.ticker AS ticker_b, a.trade_date, count(*) AS n,
         covar_pop(a.close, b.close) AS cv, stddev_pop(a.close) * stddev_pop(b.close) AS sd
  FROM seq a JOIN seq b ON a.trade_date = b.trade_date AND a.i = b.i AND a.ticker < b.ticker
  GROUP BY ALL),
correlated AS (
  SELECT r.*, COALESCE(c.n, 0) AS common_points,
         CASE WHEN c.n >= {K.MIN_CORR_POINTS} AND c.sd <> 0 THEN c.cv / c.sd END AS intraday_corr
  FROM returns r LEFT JOIN cstats c USING (ticker_a, ticker_b, trade_date)),
strong AS (SELECT * FROM correlated WHERE intraday_corr > {K.STRONG_CORR}),
strong_abs AS (SELECT * FROM correlated WHERE abs(intraday_corr) > {K.STRONG_CORR}),
psum AS (
  SELECT ticker_a, ticker_b, count(*) AS correlated_days, avg(intraday_corr) AS avg_correlation,
         avg(return_diff) AS avg_return_diff
  FROM strong GROUP BY ticker_a, ticker_b)"""

DAILY_CORR = """
dm AS (SELECT ticker, trade_date, avg(close) AS avg_close FROM bars GROUP BY ALL),
dcc AS (
  SELECT a.ticker AS ticker_a, b.ticker AS ticker_b,
         CASE WHEN stddev_pop(a.avg_close) * stddev_pop(b.avg_close) <> 0
              THEN covar_pop(a.avg_close, b.avg_close) / (stddev_pop(a.avg_close) * stddev_pop(b.avg_close))
         END AS correlation
  FROM dm a JOIN dm b ON a.trade_date = b.trade_date AND a.ticker <> b.ticker GROUP BY ALL)"""

def _slots(slot_minutes: int) -> str:
    return f"""
sl AS (
  SELECT ticker, trade_date,
         CAST(floor((date_diff('day', trade_date, CAST(timestamp AS DATE)) * 1440 + hour(timestamp) * 60
                     + minute(timestamp)) / CAST({slot_minutes} AS DOUBLE)) AS INTEGER) AS slot,
         timestamp, close
  FROM bars WHERE close IS NOT NULL),
slast AS (SELECT ticker, trade_date, slot, last(close ORDER BY timestamp, close) AS slot_close FROM sl GROUP BY ALL),
sprev AS (SELECT *, lag(slot_close) OVER (PARTITION BY ticker, trade_date ORDER BY slot) AS prev FROM slast),
sret AS (
  SELECT ticker, trade_date, slot, (slot_close - prev) / prev AS r
  FROM sprev WHERE prev IS NOT NULL AND prev <> 0)"""


def _slot_corr_sql(slot_minutes: int) -> str:
    return _q((BARS, _slots(slot_minutes)),
              "SELECT a.ticker AS ticker_a, b.ticker AS ticker_b, a.trade_date, count(*) AS common_slots, "
              f"CASE WHEN count(*) >= {K.MIN_CORR_POINTS} AND stddev_pop(a.r) * stddev_pop(b.r) <> 0 "
              "THEN covar_pop(a.r, b.r) / (stddev_pop(a.r) * stddev_pop(b.r)) END AS slot_corr "
              "FROM sret a JOIN sret b ON a.trade_date = b.trade_date AND a.slot = b.slot "
              "AND a.ticker < b.ticker GROUP BY ALL", ("slot_corr",))


TOTALS = """
tv AS (SELECT ticker, CAST(sum(day_volume) AS BIGINT) AS total_vol FROM report GROUP BY ticker)"""

REPORT_COLUMNS = ("ticker, trade_date, day_open, day_close, day_high, day_low, day_volume, bar_count, "
                  "avg_volume, rsi, signal_regime, prev_regime, prev_rsi, prev_close, regime_changed, "
                  "day_return_pct")
REPORT_DOUBLES = ("day_open", "day_close", "day_high", "day_low", "avg_volume", "rsi", "prev_rsi",
                  "prev_close", "day_return_pct")
IND_DOUBLES = ("day_open", "day_close", "day_high", "day_low", "avg_volume", "rsi")


def _with(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",".join(ctes)


def _q(ctes: tuple[str, ...], body: str, doubles=(), recursive: bool = False) -> str:
    if doubles:
        repl = ", ".join(f'ROUND("{c}", {DEC}) AS "{c}"' for c in doubles)
        body = f"SELECT * REPLACE ({repl}) FROM ({body}) AS q"
    return f"{_with(*ctes, recursive=recursive)}\n{body}"


BASE_IND = (BARS, OHLCV, RSI, IND)
BASE_REPORT = BASE_IND + (REPORT,)
BASE_CORR = BASE_IND + (PAIRS, CORRELATED)

REGIME_ORDINAL_CASE = ("CASE signal_regime "
                       + " ".join(f"WHEN '{name}' THEN CAST({i} AS DOUBLE)" for i, name in enumerate(K.REGIME_ORDER))
                       + f" ELSE CAST({K.REGIME_ORDINAL_DEFAULT} AS DOUBLE) END")


def _regime_matrix_sql(value: str) -> str:
    dates = fixture.DATES
    if value == "ordinal":
        cells = ", ".join(f"max(CASE WHEN trade_date = DATE '{d}' THEN {REGIME_ORDINAL_CASE} END) AS \"{d}\""
                          for d in dates)
        return _q(BASE_REPORT, f"SELECT ticker, {cells} FROM report GROUP BY ticker", dates, recursive=True)
    cells = ", ".join(f"COALESCE(max(CASE WHEN trade_date = DATE '{d}' THEN signal_regime END), '') AS \"{d}\""
                      for d in dates)
    return _q(BASE_REPORT, f"SELECT ticker, {cells} FROM report GROUP BY ticker", recursive=True)


def _corr_matrix_sql() -> str:
    cells_cte = """
cells AS (
  SELECT ticker_a, ticker_b, ROUND(correlation, 2) AS c FROM dcc
  UNION ALL SELECT DISTINCT ticker_a, ticker_a, 1.0 FROM dcc)"""
    cols = ", ".join(f"max(CASE WHEN ticker_b = '{t}' THEN c END) AS \"{t}\"" for t in fixture.TICKERS)
    return _q((BARS, DAILY_CORR, cells_cte), f"SELECT ticker_a, {cols} FROM cells GROUP BY ticker_a",
              fixture.TICKERS)


GRID = """
cal AS (SELECT DISTINCT trade_date FROM report),
names AS (SELECT DISTINCT ticker FROM report)"""


def _grid_sql(cell: str, doubles=()) -> str:
    return _q(BASE_REPORT + (GRID,),
              f"SELECT n.ticker, strftime(c.trade_date, '%Y-%m-%d') AS date_label, {cell} AS value "
              "FROM names n CROSS JOIN cal c LEFT JOIN report r ON r.ticker = n.ticker AND r.trade_date = c.trade_date",
              doubles, recursive=True)


PAIR_DOUBLES = ("open_a", "close_a", "rsi_a", "open_b", "close_b", "rsi_b")


def oracle_sql() -> dict[str, str]:
    R = True
    twins = {
        "scan_bars": _q((BARS,), "SELECT * FROM bars"),
        "bar_count_total": _q((BARS,), "SELECT count(*) AS total_rows FROM bars"),
        "distinct_tickers": _q((BARS,), "SELECT DISTINCT ticker FROM bars"),
        "validate_bars": _q((BARS,), "SELECT ticker, count(*) AS bar_count, count(DISTINCT trade_date) AS day_count "
                                     "FROM bars GROUP BY ticker ORDER BY ticker"),
        "validate_from_daily": _q((BARS,), "SELECT ticker, count(*) AS bar_count, count(DISTINCT trade_date) "
                                           "AS day_count FROM bars GROUP BY ticker ORDER BY ticker"),
        "validate_bitmaps": _q((BARS,), "SELECT ticker, count(*) AS bar_count, count(DISTINCT trade_date) "
                                           "AS day_count FROM bars GROUP BY ticker ORDER BY ticker"),
        "validate_merged": _q((BARS,), "SELECT ticker, count(*) AS bar_count, count(DISTINCT trade_date) "
                                           "AS day_count FROM bars GROUP BY ticker ORDER BY ticker"),
        "daily_ohlcv": _q((BARS, OHLCV), "SELECT * FROM ohlcv", ("day_open", "day_close", "day_high", "day_low")),
        "ordered_closes": _q((BARS,),
                             "SELECT ticker, trade_date, count(close) AS n_closes, "
                             "first(close ORDER BY timestamp, close) AS first_close, "
                             "last(close ORDER BY timestamp, close) AS last_close, sum(close) AS sum_closes "
                             "FROM bars GROUP BY ticker, trade_date",
                             ("first_close", "last_close", "sum_closes")),
        "rsi": _q((BARS, OHLCV, RSI), "SELECT ticker, trade_date, rsi FROM rsi", ("rsi",), R),
        "avg_volume": _q((BARS, OHLCV), "SELECT ticker, avg(day_volume) AS avg_volume FROM ohlcv GROUP BY ticker",
                         ("avg_volume",)),
        "with_avg_volume": _q((BARS, OHLCV),
                              "SELECT o.*, a.avg_volume FROM ohlcv o LEFT JOIN "
                              "(SELECT ticker, avg(day_volume) AS avg_volume FROM ohlcv GROUP BY ticker) a USING (ticker)",
                              ("day_open", "day_close", "day_high", "day_low", "avg_volume")),
        "classify_regime": _q(BASE_IND, "SELECT ticker, trade_date, rsi, day_volume / avg_volume AS volume_ratio, "
                                        "signal_regime FROM ind", ("rsi", "volume_ratio"), R),
        "indicators": _q(BASE_IND, "SELECT * FROM ind", IND_DOUBLES, R),
        "indicators_split": _q(BASE_IND, "SELECT * FROM ind", IND_DOUBLES, R),
        "indicators_one_pass": _q(BASE_IND, "SELECT * FROM ind", IND_DOUBLES, R),
        "signal_report": _q(BASE_REPORT, f"SELECT {REPORT_COLUMNS} FROM report", REPORT_DOUBLES, R),
        "regime_changes": _q(BASE_REPORT, "SELECT ticker, trade_date, prev_regime, signal_regime, rsi, day_return_pct "
                                          "FROM report WHERE regime_changed ORDER BY trade_date, ticker",
                             ("rsi", "day_return_pct"), R),
        "regime_change_count": _q(BASE_REPORT, "SELECT count(*) FILTER (WHERE regime_changed) AS regime_changes "
                                               "FROM report", (), R),
        "signal_summary": _q(BASE_REPORT, "SELECT ticker, signal_regime, count(*) AS days, avg(rsi) AS avg_rsi, "
                                          "avg(day_return_pct) AS avg_return, CAST(sum(day_volume) AS BIGINT) AS total_volume "
                                          "FROM report GROUP BY ticker, signal_regime",
                             ("avg_rsi", "avg_return"), R),
        "signal_summary_filled": _q(BASE_REPORT,
                                    "SELECT ticker, signal_regime, count(*) AS days, COALESCE(avg(rsi), 0.0) AS avg_rsi, "
                                    "COALESCE(avg(day_return_pct), 0.0) AS avg_return, "
                                    "COALESCE(CAST(sum(day_volume) AS BIGINT), 0) AS total_volume "
                                    "FROM report GROUP BY ticker, signal_regime ORDER BY ticker, signal_regime",
                                    ("avg_rsi", "avg_return"), R),
        "regime_timeline": _q(BASE_REPORT, "SELECT ticker, trade_date, signal_regime, regime_changed FROM report "
                                           "ORDER BY trade_date, ticker", (), R),
        "ticker_pairs": _q(BASE_IND + (PAIRS,), "SELECT * FROM pairs", PAIR_DOUBLES, R),
        "ticker_pairs_merge": _q(BASE_IND + (PAIRS,), "SELECT * FROM pairs", PAIR_DOUBLES, R),
        "intraday_returns": _q(BASE_IND + (PAIRS,), "SELECT ticker_a, ticker_b, trade_date, return_a, return_b, "
                                                    "return_diff FROM returns",
                               ("return_a", "return_b", "return_diff"), R),
        "pair_correlation": _q(BASE_CORR, "SELECT * FROM correlated",
                               PAIR_DOUBLES + ("intraday_corr", "return_a", "return_b", "return_diff"), R),
        "pair_correlation_split": _q(BASE_CORR, "SELECT * FROM correlated",
                                     PAIR_DOUBLES + ("intraday_corr", "return_a", "return_b", "return_diff"), R),
        "strong_pairs": _q(BASE_CORR, "SELECT ticker_a, ticker_b, trade_date, common_points, intraday_corr, "
                                      "return_diff FROM strong", ("intraday_corr", "return_diff"), R),
        "pair_summary": _q(BASE_CORR, "SELECT * FROM psum", ("avg_correlation", "avg_return_diff"), R),
        "top_pairs": _q(BASE_CORR, f"SELECT * FROM psum ORDER BY correlated_days DESC, ticker_a, ticker_b "
                                   f"LIMIT {K.TOP_PAIRS}", ("avg_correlation", "avg_return_diff"), R),
        "calendar_lag_report": _q(BASE_IND + (CALENDAR,), f"SELECT {REPORT_COLUMNS} FROM calendar",
                                  REPORT_DOUBLES, R),
        "missed_transitions": _q(BASE_REPORT + (CALENDAR,),
                                 "SELECT r.ticker, r.trade_date, r.prev_regime, r.signal_regime, "
                                 "CAST(date_diff('day', r.prev_date, r.trade_date) AS INTEGER) AS gap_days "
                                 "FROM (SELECT *, lag(trade_date) OVER (PARTITION BY ticker ORDER BY trade_date) "
                                 "AS prev_date FROM report) r "
                                 "WHERE r.regime_changed AND NOT EXISTS (SELECT 1 FROM calendar c WHERE "
                                 "c.ticker = r.ticker AND c.trade_date = r.trade_date AND c.regime_changed)", (), R),
        "transition_counts": _q(BASE_REPORT + (CALENDAR,),
                                "SELECT count(*) FILTER (WHERE r.regime_changed) AS row_lag_changes, "
                                "count(*) FILTER (WHERE c.regime_changed) AS calendar_lag_changes, "
                                "count(*) FILTER (WHERE r.regime_changed AND NOT c.regime_changed) AS missed "
                                "FROM report r JOIN calendar c USING (ticker, trade_date)", (), R),
        "regime_ordinal": _q(BASE_REPORT, f"SELECT ticker, trade_date, signal_regime, {REGIME_ORDINAL_CASE} "
                                          f"AS regime_ordinal FROM report", ("regime_ordinal",), R),
        "regime_matrix": _regime_matrix_sql("ordinal"),
        "regime_label_matrix": _regime_matrix_sql("label"),
        "regime_grid": _grid_sql(f"CASE WHEN r.ticker IS NOT NULL THEN {REGIME_ORDINAL_CASE} END", ("value",)),
        "regime_label_grid": _grid_sql("COALESCE(signal_regime, '')"),
        "daily_close_corr": _q((BARS, DAILY_CORR), "SELECT * FROM dcc", ("correlation",)),
        "corr_matrix": _corr_matrix_sql(),
        "top_tickers": _q(BASE_REPORT + (TOTALS,), "SELECT * FROM tv ORDER BY total_vol DESC, ticker", (), R),
        "ohlcv_feed": _q(BASE_REPORT + (TOTALS,),
                         "SELECT ticker, trade_date, day_open, day_high, day_low, day_close, day_volume, "
                         "CASE WHEN day_close >= day_open THEN 'UP' ELSE 'DOWN' END AS direction FROM report "
                         f"WHERE ticker IN (SELECT ticker FROM tv ORDER BY total_vol DESC, ticker "
                         f"LIMIT {K.OHLCV_FEED_TICKERS}) ORDER BY ticker, trade_date",
                         ("day_open", "day_high", "day_low", "day_close"), R),
        "rsi_feed": _q(BASE_REPORT + (TOTALS,),
                       f"SELECT ticker, trade_date, rsi, CASE WHEN rsi IS NULL THEN NULL "
                       f"WHEN rsi >= {K.OVERBOUGHT} THEN 'OVERBOUGHT' WHEN rsi <= {K.OVERSOLD} THEN 'OVERSOLD' "
                       f"ELSE 'MID' END AS rsi_band FROM report "
                       f"WHERE ticker IN (SELECT ticker FROM tv ORDER BY total_vol DESC, ticker "
                       f"LIMIT {K.RSI_FEED_TICKERS}) ORDER BY ticker, trade_date", ("rsi",), R),
        "slot_return_corr": _slot_corr_sql(60),
        "slot_return_corr_1m": _slot_corr_sql(1),
        "write_roundtrip": _q(BASE_REPORT, f"SELECT {REPORT_COLUMNS} FROM report", REPORT_DOUBLES, R),
        "write_partitioned_roundtrip": _q(BASE_REPORT, f"SELECT {REPORT_COLUMNS} FROM report", REPORT_DOUBLES, R),
        "write_verify": _q(BASE_REPORT, "SELECT count(*) AS rows, 1 AS files FROM report", (), R),
        "indicators_trailing": _q((BARS, OHLCV, RSI, IND_TRAILING), "SELECT * FROM ind", IND_DOUBLES, R),
        "read_bars_table": _q((BARS,), "SELECT * FROM bars"),
        "one_ticker_bars": _q((BARS,), f"SELECT * FROM bars WHERE ticker = '{fixture.TICKER}'"),
        "regime_changes_preview": _q(BASE_REPORT, "SELECT ticker, trade_date, prev_regime, signal_regime, rsi, day_return_pct "
                                                  f"FROM report WHERE regime_changed ORDER BY trade_date, ticker LIMIT {K.TOP_CHANGES}",
                                     ("rsi", "day_return_pct"), R),
        "strong_pairs_abs": _q(BASE_CORR, "SELECT ticker_a, ticker_b, trade_date, common_points, intraday_corr, "
                                          "return_diff FROM strong_abs", ("intraday_corr", "return_diff"), R),
    }
    same = {"ordered_closes_array": "ordered_closes", "strong_pairs_abs_bounded": "strong_pairs_abs",
            "indicators_bucketed": "indicators", "write_replace_days": "write_roundtrip",
            "rsi_sequence": "rsi", "with_avg_volume_merge": "with_avg_volume", "write_rebalanced_roundtrip": "write_roundtrip",
            "write_table_roundtrip": "write_roundtrip", "pipeline_report": "signal_report",
            "pipeline_signal_summary": "signal_summary_filled", "pipeline_pair_summary": "pair_summary"}
    return twins | {name: twins[of] for name, of in same.items()}
