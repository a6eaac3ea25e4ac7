"""The seven-stage signal pipeline as one reusable job.

Stages: (1) load and validate, (2)+(3) daily OHLCV, RSI and regimes,
(4) pair correlation summary, (5) day-over-day report, (6) write and
verify, (7) regime summary from the written table. Only bounded results
reach the driver (counts, the top-k pair list); everything else stays a
DataFrame. The bars are read and shuffled once: their close blocks with the
day partials, and the daily rows merged from them, are written as two
Parquet tables in the session's shared folder. Later stages read the
columns they need from these; a lost executor re-reads files instead of
recomputing from the bars. The folders belong to the results returned
(which are lazy), so whoever owns the shared folder removes them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from .. import operators as op
from ..session import stage, staging_path
from ..sources import null_key, read_signals, write_signals


@dataclass
class PipelineConfig:
    period: int = K.RSI_PERIOD
    min_points: int = K.MIN_CORR_POINTS
    threshold: float = K.STRONG_CORR
    top_pairs: int = K.TOP_PAIRS
    output: str | None = None           # path or table; default: a fresh folder under the shared dir
    files: int | None = None            # at most so many output files (coalesce); default: by size
    partition_by: list[str] | None = None
    calendar_lag: bool = False          # opt-in: previous calendar day instead of previous trading day
    stage: bool = True                  # write the close blocks and daily rows as tables
    drop_null_keys: bool = True         # leave out bars without ticker, trade_date or timestamp, and report their number
    split_minutes: int | None = None    # chunk each day (hot ticker-days)
    regime_args: dict = field(default_factory=dict)


def run_pipeline(spark: SparkSession, bars: DataFrame, cfg: PipelineConfig | None = None) -> dict:
    cfg = cfg or PipelineConfig()
    out: dict = {}
    # One pass over the bars: blocks of closes with the day's partials, then the daily
    # rows merged from the partials alone. Every later stage reads these two.
    loaded = Observation("load")
    bars = bars.observe(loaded, F.count_if(null_key()).alias("dropped"))
    if cfg.drop_null_keys:
        bars = bars.where(~null_key())
    blocks = op.close_blocks(bars, cfg.period, split_minutes=cfg.split_minutes)
    if cfg.stage:
        blocks = stage(blocks, "blocks")
    daily = op.merge_day(blocks, cfg.period)
    if cfg.stage:
        daily = stage(daily, "daily")
    # Stage 1: validation from the daily rows (the bar count is read below, with
    # the write check, from the report's bar_count column).
    out["validation"] = op.validate_daily(daily)
    # Stages 2-3: average volume (window over the daily rows) and regimes.
    ind = op.with_regime(daily, **cfg.regime_args)
    out["indicators"] = ind
    # Stage 5 (+6): day-over-day report, written, read back; rows, files and the number of
    # regime changes (and the bar count) come from one aggregate over the written table.
    report = op.calendar_lag_report(ind) if cfg.calendar_lag else op.signal_report(ind)
    target = cfg.output or staging_path(spark, "signals")
    write_signals(report, target, files=cfg.files, partition_by=cfg.partition_by)
    written = read_signals(spark, target, schema=report.schema)
    check = written.agg(
        F.expr("count(1) AS rows"),
        F.expr("count(DISTINCT _metadata.file_path) AS files"),
        F.expr("count_if(regime_changed) AS regime_changes"),
        F.expr("coalesce(sum(bar_count), 0) AS total_rows"),
    ).first()
    out["total_rows"] = check["total_rows"]
    out["dropped_rows"] = loaded.get["dropped"] if cfg.drop_null_keys else 0
    out["report"] = written
    out["output"] = target
    out["written"] = {"rows": check["rows"], "files": check["files"]}
    out["regime_changes"] = check["regime_changes"]
    # Stage 4: strong pairs, from the same staged relation.
    correlated = op.pair_correlation_of(daily, op.block_rows(blocks), cfg.min_points)
    summary = op.pair_summary(correlated, cfg.threshold)
    out["pair_summary"] = summary
    out["top_pairs"] = op.top_pairs(summary, cfg.top_pairs).collect()
    # Stage 7: regime summary from the written table.
    out["signal_summary"] = op.signal_summary_filled(written)
    return out
