"""Matrices without column lists, correlation tiles, pages, bucketed bars, replaced partitions, null keys."""

import datetime as dt
import random
import uuid

import numpy as np
import pytest
from conftest import day_of, make_bars
from pyspark.errors import PySparkException

from barsmith import operators as op
from barsmith.plans.shape import physical_plan
from barsmith.session import staging_path
from barsmith.sources import bars_from_events, null_key_rows, read_bars, read_signals, write_bar_table, write_signals


def _report(spark):
    rows = [("A", dt.date(2024, 1, 2), "BUY"), ("A", dt.date(2031, 5, 6), "SELL"), ("B", dt.date(1999, 12, 31), "UNKNOWN"),
            ("B", dt.date(2024, 1, 2), None), ("C", dt.date(2031, 5, 6), "odd"), ("C", dt.date(2031, 5, 6), "BUY"), (None, dt.date(2024, 1, 2), "BUY"),
            ("D", None, "SELL")]
    return spark.createDataFrame(rows, "ticker string, trade_date date, signal_regime string")


def test_grid_holds_every_cell_of_any_span(spark):
    report = _report(spark)
    dates = op.date_dimension(report)
    labels = [r.date_label for r in dates.orderBy("date_index").collect()]
    assert labels == ["", "1999-12-31", "2024-01-02", "2031-05-06"]
    grid = {r.ticker: r.cells for r in op.regime_grid(report, dates, "label").collect()}
    assert grid == {"A": ["", "", "BUY", "SELL"], "B": ["", "UNKNOWN", "", ""], "C": ["", "", "", "odd"], None: ["", "", "BUY", ""],
                    "D": ["SELL", "", "", ""]}
    ordinal = {r.ticker: r.cells for r in op.regime_grid(report, dates).collect()}
    assert ordinal["A"][0] is None and ordinal["A"][2] == 1.0 and len(ordinal["C"]) == 4
    cells = op.grid_cells(op.regime_grid(report, dates, "label"), dates).collect()
    assert len(cells) == 20 and sum(c.value != "" for c in cells) == 6
    empty = report.limit(0)
    assert op.regime_grid(empty, op.date_dimension(empty)).count() == 0


def test_pivot_equals_grid_and_fails_on_an_unlisted_date(spark):
    report = _report(spark).where("ticker IS NOT NULL AND trade_date IS NOT NULL")
    dates = op.date_dimension(report)
    labels = [r.date_label for r in dates.orderBy("date_index").collect()]
    for value in ("ordinal", "label"):
        grid = {r.ticker: r.cells for r in op.regime_grid(report, dates, value).collect()}
        assert {r.ticker: list(r)[1:] for r in op.regime_matrix(report, labels, value).collect()} == grid
    with pytest.raises(PySparkException, match="no column for date 2031-05-06"):
        op.regime_matrix(report, labels[:2]).collect()


def _daily(spark, closes):
    """closes[ticker][day] -> one bar a day from 2024-01-01; None: no bar."""
    rows = [(t, (dt.date(2022, 1, 1) + dt.timedelta(days=i)).isoformat(), 600, 1.0, c, 1)
            for t, cs in closes.items() for i, c in enumerate(cs) if c is not None]
    return make_bars(spark, rows)


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_correlation_tiles_equal_numpy(spark, buckets):
    rng = random.Random(2)
    closes = {f"T{t:02d}": [None if rng.random() < 0.2 else round(100 + rng.gauss(0, 3), 2) for _ in range(60)] for t in range(12)}
    closes["FLAT"] = [5.0] * 60
    closes["LATE"] = [None] * 50 + [float(i * i % 7) for i in range(10)] + [None] * 600 + [1.0, 9.0, 4.0]
    closes["NEVER"] = [None] * 700 + [1.0]
    bars = _daily(spark, closes)
    got = {(r.ticker_a, r.ticker_b): r.correlation for r in op.daily_close_corr(bars, buckets=buckets).collect()}
    for a in closes:
        for b in closes:
            both = [(x, y) for x, y in zip(closes[a], closes[b]) if x is not None and y is not None]
            if a == b or not both:
                assert (a, b) not in got
                continue
            x, y = np.array(both).T
            want = None if x.std() * y.std() == 0 else float(np.mean((x - x.mean()) * (y - y.mean())) / (x.std() * y.std()))
            assert got[a, b] == (None if want is None else pytest.approx(want, abs=1e-9))
    once = {(r.ticker_a, r.ticker_b) for r in op.daily_close_corr(bars, ordered=False, buckets=buckets).collect()}
    assert all(a < b for a, b in once) and len(got) == 2 * len(once)
    plan = physical_plan(op.daily_close_corr(bars, buckets=buckets))
    assert "Join" not in plan and "Cartesian" not in plan


def test_correlation_matrix_fails_on_an_unlisted_ticker(spark):
    bars = _daily(spark, {"A": [1.0, 2.0, 3.0], "B": [2.0, 1.0, 5.0], "C": [1.0, 1.5, 1.0]})
    assert op.corr_matrix(bars).columns == ["ticker_a", "A", "B", "C"]
    with pytest.raises(PySparkException, match="no column for ticker C"):
        op.corr_matrix(bars, ["A", "B"]).collect()


@pytest.mark.parametrize("split", [None, 7])
def test_pages_are_bounded_and_join_to_the_day(spark, split):
    rng = random.Random(4)
    rows = day_of([round(rng.uniform(1, 9), 2) for _ in range(103)]) + day_of([3.0] * 10, ticker="B")
    rows[20] = rows[20][:4] + (None, 100)
    rows.append(("N", "2024-01-02", 600, 1.0, None, 5))
    bars = make_bars(spark, rows)
    pages = op.close_pages(bars, page=10, split_minutes=split).collect()
    assert max(len(p.closes) for p in pages) == 10
    for day in op.ordered_closes(bars).collect():
        own = sorted((p for p in pages if p.ticker == day.ticker and p.page is not None), key=lambda p: p.page)
        assert [c for p in own for c in p.closes] == day.all_closes
        assert [p.offset for p in own] == [10 * p.page for p in own]
    digest = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())
    paged = op.pages_digest(op.close_pages(bars, page=10, split_minutes=split))
    by = {r[0]: r for r in digest(op.closes_digest(op.ordered_closes(bars)).where("n_closes > 0"))}
    assert {r[0]: r for r in digest(paged.where("n_closes > 0"))} == by
    assert paged.where("ticker = 'N'").first().n_closes == 0


def test_bucketed_bars_are_not_shuffled(spark):
    rows = day_of([1.0, 2.0, 3.0, 2.5] * 8) + day_of([2.0, 1.0], ticker="B") + day_of([5.0, 4.0], day="2024-01-03")
    bars = make_bars(spark, rows)
    name = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{staging_path(spark, 'db')}'")
    write_bar_table(bars, f"{name}.bars", 5)
    back = read_bars(spark, f"{name}.bars", fmt="table")
    for df in (op.daily_bars(back), op.daily_ohlcv(back), op.intraday_rsi(back)):
        plan = physical_plan(df)
        assert "Exchange" not in plan and "Bucketed: true" in plan, plan
    plan = physical_plan(op.indicators(back))
    assert plan.count("Exchange") == 1, plan  # the daily rows, by ticker
    assert sorted(op.indicators(back).collect()) == sorted(op.indicators(bars).collect())


def _signals(spark, rows):
    return spark.createDataFrame([(t, dt.date.fromisoformat(d), v) for t, d, v in rows], "ticker string, trade_date date, rsi double")


@pytest.mark.parametrize("kind", ["path", "table"])
def test_a_second_run_replaces_its_days_alone(spark, kind):
    target = staging_path(spark, "replace")
    if kind == "table":
        db = f"replace_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {db} LOCATION '{target}'")
        target = f"{db}.signals"
    first = _signals(spark, [("A", "2024-01-02", 1.0), ("B", "2024-01-02", 2.0), ("A", "2024-01-03", 3.0)])
    second = _signals(spark, [("A", "2024-01-03", 30.0), ("C", "2024-01-04", 40.0)])
    write_signals(first, target, partition_by=["trade_date"], replace="partitions")
    write_signals(second, target, partition_by=["trade_date"], replace="partitions")
    if kind == "table":
        spark.catalog.refreshTable(target)
    got = sorted((r.ticker, str(r.trade_date), r.rsi) for r in read_signals(spark, target, schema=first.schema).collect())
    assert got == [("A", "2024-01-02", 1.0), ("A", "2024-01-03", 30.0), ("B", "2024-01-02", 2.0), ("C", "2024-01-04", 40.0)]
    write_signals(second, target, partition_by=["trade_date"])
    assert read_signals(spark, target, schema=first.schema).count() == 2
    with pytest.raises(ValueError):
        write_signals(second, target, replace="partitions")


def test_events_without_a_type_or_time_are_bars_with_null_keys(spark):
    rows = [(1, dt.datetime(2024, 1, 2, 9, 30), 1, "a", 1.0, ""), (2, dt.datetime(2024, 1, 2, 9, 31), 1, None, 2.0, ""), (3, None, 1, "a", 3.0, "")]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    bars = bars_from_events(events)
    got = sorted(((r.ticker, r.timestamp, r.close) for r in bars.collect()), key=str)
    assert len(got) == 3 and null_key_rows(bars).first()[0] == 2
    assert ("a", dt.datetime(2024, 1, 2, 9, 30)) in [g[:2] for g in got]
