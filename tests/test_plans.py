"""Plan shape: no Python evaluation, no pair explosion, bounded shuffle counts."""

import pytest

from barsmith import operators as op
from barsmith.plans.registry import QUERIES
from barsmith.plans.shape import count_nodes, explodes_pairs, physical_plan, uses_python
from barsmith.sources import fixture_bars

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_cartesian(spark, name):
    df = QUERIES[name](spark, SF)
    assert not uses_python(df), name
    assert not explodes_pairs(df), name


def _shuffles(df):
    plan = physical_plan(df)
    return count_nodes(plan, "Exchange")


def test_indicators_shuffle_budget(spark):
    from conftest import day_of, make_bars
    bars = make_bars(spark, day_of([1.0, 2.0, 3.0]) + day_of([2.0, 1.0], ticker="B"))
    plan = physical_plan(op.signal_report(op.indicators(bars)))
    # one shuffle of bars by (ticker, trade_date), one of daily rows by ticker
    assert count_nodes(plan, "Exchange") == 2, plan
    assert "Join" not in plan, plan


def test_indicator_aggregate_reuses_window_partitioning(spark):
    bars = fixture_bars(spark, SF)
    plan = physical_plan(op.daily_bars(bars))
    # The OHLCV/RSI aggregate sits on the window's (ticker, trade_date) shuffle.
    agg_at = plan.find("SortAggregate")
    assert agg_at >= 0
    between = plan[:plan.find("Window")]
    assert "Exchange" not in between[agg_at:], plan


def test_pair_plan_joins_on_date_and_position(spark):
    bars = fixture_bars(spark, SF)
    plan = physical_plan(op.pair_correlation(bars))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert ("SortMergeJoin" in plan) or ("BroadcastHashJoin" in plan) or ("ShuffledHashJoin" in plan)


def test_scan_prunes_columns_and_pushes_filters(spark):
    from pyspark.sql import functions as F
    ev = spark.read.parquet(f"{SF}/events.parquet")
    plan = physical_plan(ev.where(F.col("event_type") == "click").select("ts"))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan


def _plain_bars(spark):
    from conftest import day_of, make_bars
    return make_bars(spark, day_of([1.0, 2.0, 3.0]) + day_of([2.0, 1.0], ticker="B")
                     + day_of([5.0, 6.0], day="2024-01-03"))


def test_ohlcv_is_one_shuffle_with_partial_aggregation(spark):
    plan = physical_plan(op.daily_ohlcv(_plain_bars(spark)))
    assert count_nodes(plan, "Exchange") == 1, plan
    assert "partial_min" in plan and "partial_sum" in plan, plan


def test_validation_shuffle_budget(spark):
    plan = physical_plan(op.validate_bars(_plain_bars(spark)))
    # ticker-day counts, per-ticker counts, ordered output
    assert count_nodes(plan, "Exchange") <= 3, plan
    approx = physical_plan(op.validate_bars(_plain_bars(spark), exact=False))
    assert count_nodes(approx, "Exchange") <= 2, approx
    rows = {r.ticker: (r.bar_count, r.day_count) for r in op.validate_bars(_plain_bars(spark), exact=False).collect()}
    assert rows == {"AAA": (5, 2), "B": (2, 1)}


def _executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _written(spark, df, name):
    from barsmith.session import stage
    return stage(df, f"test-{name}")


@pytest.mark.parametrize("which", ["pairs", "slots"])
def test_self_join_sides_share_one_exchange(spark, which):
    bars = _written(spark, fixture_bars(spark, SF), "bars")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _executed(op.pair_correlation(bars) if which == "pairs" else op.slot_return_corr(bars, 60))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ReusedExchange" in plan, plan
    assert "REPARTITION_BY_COL" not in plan, plan  # left to adaptive skew-join splitting
    assert not any(n in plan for n in ("BroadcastNestedLoopJoin", "CartesianProduct", "aggregate(")), plan


def test_split_blocks_gather_no_day_in_a_window(spark):
    plan = physical_plan(op.close_blocks(_plain_bars(spark), split_minutes=60))
    rows = [line for line in plan.splitlines() if "Window [" in line]
    assert rows and all("_chunk" in line or "_cnt" in line for line in rows), plan
    merged = physical_plan(op.merge_day(_written(spark, op.close_blocks(_plain_bars(spark)), "merge")))
    # the only window is over chapters, which the blocks are merged into before it
    assert -1 < merged.rfind("Window [") < merged.rfind("partial_min"), merged


def test_day_rows_do_not_read_the_closes(spark):
    import contextlib
    import io
    blocks = _written(spark, op.close_blocks(_plain_bars(spark)), "blocks")
    for df, reads in ((op.merge_day(blocks), False), (op.block_rows(blocks), True)):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        schema = [line for line in buf.getvalue().splitlines() if line.startswith("ReadSchema")]
        assert len(schema) == 1 and ("xs:" in schema[0]) == reads, schema


@pytest.mark.parametrize("name", ["ohlcv_feed", "rsi_feed", "with_avg_volume"])
def test_shared_inputs_are_read_from_a_staged_table(spark, name):
    plan = _executed(QUERIES[name](spark, SF))
    final = plan.split("== Initial Plan ==")[0]
    assert "events.parquet" not in final and final.count("Scan parquet") == 2, plan


def test_one_ticker_query_pushes_the_predicate(spark):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES["one_ticker_bars"](spark, SF).explain("formatted")
    assert "EqualTo(ticker,view)" in buf.getvalue(), buf.getvalue()


def test_flagship_on_parquet_pushes_ticker_filter_to_the_scan(spark):
    import contextlib
    import io

    from barsmith.session import staging_path
    from barsmith.sources import read_bars
    path = staging_path(spark, "test-flagship")
    _plain_bars(spark).write.parquet(path)
    df = op.signal_report(op.indicators(read_bars(spark, path))).where("ticker = 'AAA'")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    pushed = [line for line in text.splitlines() if line.startswith("PushedFilters")]
    assert pushed and "EqualTo(ticker,AAA)" in pushed[0], text
    assert count_nodes(physical_plan(df), "Exchange") == 2
    assert df.count() == 2


def test_day_bitmaps_take_one_exchange(spark):
    from conftest import day_of, make_bars
    bars = make_bars(spark, day_of([1.0, 2.0, 3.0]) + day_of([2.0, 1.0], ticker="B"))
    assert _shuffles(op.validate_bitmaps(op.day_bitmaps(bars), ordered=False)) == 1
    assert _shuffles(op.validate_bars(bars, ordered=False)) == 2
    assert "SortAggregate" not in physical_plan(op.day_bitmaps(bars))
