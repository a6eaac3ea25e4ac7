"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Each reads the test-data tables under ``sf_dir`` (bars are derived from
``events``) and runs the operator over the whole input. Double columns are
rounded to ``CHECK_DECIMALS`` places, the comparison format shared with the
SQL twins in ``oracle.py`` (two engines sum floats in different orders).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from .. import operators as op
from ..functions import classify_regime, regime_ordinal
from ..session import stage, staging_path
from ..sources import fixture_bars, read_bars, read_signals, verify_write, write_bar_table, write_signals
from . import fixture
from .pipeline import run_pipeline

CHECK_DECIMALS = 6
PAIR_CHECK_COLUMNS = ("ticker_a", "ticker_b", "trade_date")


def round_doubles(df: DataFrame, decimals: int = CHECK_DECIMALS) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    if not doubles:
        return df
    return df.select(*[
        F.expr(f"round(`{name}`, {decimals}) AS `{name}`") if name in doubles else F.expr(f"`{name}`")
        for name in df.columns
    ])


def _bars(spark: SparkSession, sf: str) -> DataFrame:
    return fixture_bars(spark, sf)


def _ind(spark: SparkSession, sf: str) -> DataFrame:
    return op.indicators(_bars(spark, sf))


def _report(spark: SparkSession, sf: str) -> DataFrame:
    return op.signal_report(_ind(spark, sf))


def _correlated(spark: SparkSession, sf: str) -> DataFrame:
    return op.pair_correlation(_bars(spark, sf))


def q_scan_bars(spark, sf):
    return _bars(spark, sf)


def q_bar_count_total(spark, sf):
    return op.bar_count_total(_bars(spark, sf))


def q_distinct_tickers(spark, sf):
    return op.distinct_tickers(_bars(spark, sf))


def q_validate_bars(spark, sf):
    return op.validate_bars(_bars(spark, sf))


def q_validate_bitmaps(spark, sf):
    return op.validate_bitmaps(op.day_bitmaps(_bars(spark, sf)))


def q_validate_merged(spark, sf):
    # Two deliveries that share days: the bars of even and of odd minutes.
    bars = _bars(spark, sf)
    even = "minute(timestamp) % 2 = 0"
    sets = [op.day_bitmaps(bars.where(part)) for part in (even, f"NOT coalesce({even}, false)")]
    return op.validate_bitmaps(op.merge_day_bitmaps(sets[0].unionByName(sets[1])))


def q_daily_ohlcv(spark, sf):
    return op.daily_ohlcv(_bars(spark, sf))


def q_ordered_closes(spark, sf):
    return op.pages_digest(op.close_pages(_bars(spark, sf), split_minutes=60))


def q_ordered_closes_array(spark, sf):
    return op.closes_digest(op.ordered_closes(_bars(spark, sf)))


def q_rsi(spark, sf):
    return op.intraday_rsi(_bars(spark, sf))


def q_avg_volume(spark, sf):
    return op.avg_volume(op.daily_ohlcv(_bars(spark, sf)))


def q_with_avg_volume(spark, sf):
    return op.with_avg_volume(stage(op.daily_ohlcv(_bars(spark, sf)), "daily"))


def q_with_avg_volume_merge(spark, sf):
    return op.with_avg_volume(stage(op.daily_ohlcv(_bars(spark, sf)), "daily"), strategy="merge")


def q_classify_regime(spark, sf):
    daily = op.with_avg_volume_window(op.daily_bars(_bars(spark, sf)))
    return daily.select(
        F.expr("ticker"), F.expr("trade_date"), F.expr("rsi"),
        F.expr("try_divide(CAST(day_volume AS DOUBLE), avg_volume) AS volume_ratio"),
        classify_regime().alias("signal_regime"))


def q_indicators(spark, sf):
    return _ind(spark, sf)


def q_indicators_one_pass(spark, sf):
    # The indicator table from the day partials of the close blocks, as in the pipeline.
    return op.with_regime(op.merge_day(op.close_blocks(_bars(spark, sf))))


def q_validate_from_daily(spark, sf):
    return op.validate_daily(op.merge_day(op.close_blocks(_bars(spark, sf))))


def q_indicators_split(spark, sf):
    # Same result through the hot-day path: no window holds a whole ticker-day (60-minute chunks).
    return op.indicators(_bars(spark, sf), split_minutes=60)


def q_indicators_trailing(spark, sf):
    return op.with_regime(op.daily_bars(_bars(spark, sf)), trailing_days=fixture.TRAILING_DAYS)


def q_rsi_sequence(spark, sf):
    # The composed form: days in blocks of 8 closes dealt by hour.
    return op.intraday_rsi(_bars(spark, sf), split_minutes=60, block=8)


def q_signal_report(spark, sf):
    return _report(spark, sf)


def q_regime_changes(spark, sf):
    return op.regime_changes(_report(spark, sf))


def q_regime_changes_preview(spark, sf):
    return op.regime_changes(_report(spark, sf), limit=K.TOP_CHANGES)


def q_regime_change_count(spark, sf):
    return op.regime_change_count(_report(spark, sf))


def q_signal_summary(spark, sf):
    return op.signal_summary(_report(spark, sf))


def q_signal_summary_filled(spark, sf):
    return op.signal_summary_filled(_report(spark, sf))


def q_regime_timeline(spark, sf):
    return op.regime_timeline(_report(spark, sf))


def q_ticker_pairs(spark, sf):
    return op.ticker_pairs(_ind(spark, sf))


def q_ticker_pairs_merge(spark, sf):
    return op.ticker_pairs(_ind(spark, sf), strategy="merge")


def q_intraday_returns(spark, sf):
    pairs = op.intraday_returns(op.ticker_pairs(_ind(spark, sf)))
    return pairs.select(*PAIR_CHECK_COLUMNS, "return_a", "return_b", "return_diff")


def q_pair_correlation(spark, sf):
    return _correlated(spark, sf)


def q_pair_correlation_split(spark, sf):
    # The hot-day path for pairs: chunked intraday sequences.
    return op.pair_correlation(_bars(spark, sf), split_minutes=60)


def q_strong_pairs(spark, sf):
    # Only pair-days whose bound exceeds the threshold are correlated.
    return op.strong_pair_days(_bars(spark, sf)).select(*PAIR_CHECK_COLUMNS, "common_points", "intraday_corr", "return_diff")


def q_strong_pairs_abs(spark, sf):
    return op.strong_pairs(_correlated(spark, sf), absolute=True).select(*PAIR_CHECK_COLUMNS, "common_points",
                                                                         "intraday_corr", "return_diff")


def q_strong_pairs_abs_bounded(spark, sf):
    return op.strong_pair_days(_bars(spark, sf), absolute=True).select(*PAIR_CHECK_COLUMNS, "common_points",
                                                                       "intraday_corr", "return_diff")


def q_pair_summary(spark, sf):
    return op.pair_summary(op.strong_pair_days(_bars(spark, sf)))


def q_top_pairs(spark, sf):
    return op.top_pairs(op.pair_summary(_correlated(spark, sf)))


def q_calendar_lag_report(spark, sf):
    return op.calendar_lag_report(_ind(spark, sf))


def q_missed_transitions(spark, sf):
    return op.missed_transitions(_ind(spark, sf))


def q_transition_counts(spark, sf):
    return op.transition_counts(_ind(spark, sf))


def q_regime_ordinal(spark, sf):
    return _report(spark, sf).select(F.expr("ticker"), F.expr("trade_date"), F.expr("signal_regime"),
                                     regime_ordinal().alias("regime_ordinal"))


def q_regime_matrix(spark, sf):
    return op.regime_matrix(_report(spark, sf), dates=fixture.DATES)


def q_regime_label_matrix(spark, sf):
    return op.regime_matrix(_report(spark, sf), dates=fixture.DATES, value="label")


def _grid(spark, sf, value):
    report = stage(_report(spark, sf), "report")
    dates = stage(op.date_dimension(report), "dates")
    return op.grid_cells(op.regime_grid(report, dates, value), dates)


def q_regime_grid(spark, sf):
    # The matrix without a column list: every cell of any span of dates.
    return _grid(spark, sf, "ordinal")


def q_regime_label_grid(spark, sf):
    return _grid(spark, sf, "label")


def q_daily_close_corr(spark, sf):
    return op.daily_close_corr(_bars(spark, sf))


def q_corr_matrix(spark, sf):
    return op.corr_matrix(_bars(spark, sf), tickers=fixture.TICKERS, decimals=2)


def q_top_tickers(spark, sf):
    return op.top_tickers(_report(spark, sf))


def q_ohlcv_feed(spark, sf):
    return op.ohlcv_feed(stage(_report(spark, sf), "report"))


def q_rsi_feed(spark, sf):
    return op.rsi_feed(stage(_report(spark, sf), "report"))


def q_slot_return_corr(spark, sf):
    return op.slot_return_corr(_bars(spark, sf), slot_minutes=60)


def q_slot_return_corr_1m(spark, sf):
    return op.slot_return_corr(_bars(spark, sf), slot_minutes=1)


def _written_report(spark, sf, partition_by=None, files=K.OUTPUT_FILES, target=None):
    report = _report(spark, sf)
    target = target or staging_path(spark, "report")
    write_signals(report, target, files=files, partition_by=partition_by)
    return read_signals(spark, target, schema=report.schema)


def q_write_roundtrip(spark, sf):
    return _written_report(spark, sf)


def q_write_rebalanced_roundtrip(spark, sf):
    return _written_report(spark, sf, files=None)


def q_write_partitioned_roundtrip(spark, sf):
    return _written_report(spark, sf, partition_by=["ticker", "signal_regime"])


def q_write_table_roundtrip(spark, sf):
    # Into a catalog table, partitioned, and back in the written column order.
    return _written_report(spark, sf, partition_by=["ticker", "signal_regime"], target=_table_name(spark, "report"))


def q_write_verify(spark, sf):
    return verify_write(_written_report(spark, sf, files=1))


def _table_name(spark: SparkSession, kind: str) -> str:
    """A new catalog table's name, in a database of its own whose files lie in the shared folder."""
    database = f"barsmith_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{staging_path(spark, 'database')}'")
    return f"{database}.{kind}"


# A bar table's own column names, for the reader's mapping.
SOURCE_NAMES = {"ticker": "symbol", "timestamp": "bar_time", "volume": "shares"}


def q_read_bars_table(spark, sf):
    # The real reader: a catalog table with other column names and types, and a bar without a key.
    bars = _bars(spark, sf)
    keyless = bars.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in bars.schema.fields]).limit(1)
    name = _table_name(spark, "bars")
    (bars.unionByName(keyless).withColumn("trade_date", F.col("trade_date").cast("string"))
     .withColumnsRenamed(SOURCE_NAMES).write.saveAsTable(name))
    return read_bars(spark, name, fmt="table", mapping=SOURCE_NAMES)


def q_indicators_bucketed(spark, sf):
    # Over a bar table bucketed by (ticker, trade_date): no exchange of bars.
    name = _table_name(spark, "bars")
    write_bar_table(_bars(spark, sf), name, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return op.indicators(read_bars(spark, name, fmt="table"))


def q_write_replace_days(spark, sf):
    # A first run with wrong days, then a run of these days alone: the others stay as they are.
    report = stage(_report(spark, sf), "report")
    wrong = F.expr("dayofmonth(trade_date) % 2 = 0")
    path = staging_path(spark, "days")
    write_signals(report.withColumn("rsi", F.when(wrong, F.lit(-1.0)).otherwise(F.col("rsi"))), path, partition_by=["trade_date"])
    write_signals(report.where(wrong), path, partition_by=["trade_date"], replace="partitions")
    return read_signals(spark, path, schema=report.schema)


def q_one_ticker_bars(spark, sf):
    # The ticker predicate reaches the scan of the written bars.
    path = staging_path(spark, "bars")
    _bars(spark, sf).write.parquet(path)
    return read_bars(spark, path).where(F.col("ticker") == fixture.TICKER)


def _pipeline(spark, sf):
    return run_pipeline(spark, _bars(spark, sf))


def q_pipeline_report(spark, sf):
    return _pipeline(spark, sf)["report"]


def q_pipeline_signal_summary(spark, sf):
    return _pipeline(spark, sf)["signal_summary"]


def q_pipeline_pair_summary(spark, sf):
    return _pipeline(spark, sf)["pair_summary"]


RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


def _checked(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(fn(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _checked(v) for k, v in RAW.items()}
