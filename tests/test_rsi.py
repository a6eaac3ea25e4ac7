import random

import pytest
from pyspark.sql import functions as F
from conftest import day_of, make_bars, wilder_rsi

from barsmith import operators as op


def _rsi(spark, closes, **kw):
    rows = op.intraday_rsi(make_bars(spark, day_of(closes)), **kw).collect()
    return rows[0].rsi


def test_fourteen_closes_is_null(spark):
    assert _rsi(spark, [float(i) for i in range(14)]) is None


def test_rising_falling_flat(spark):
    assert _rsi(spark, [float(i) for i in range(15)]) == 100.0
    assert _rsi(spark, [float(20 - i) for i in range(15)]) == 0.0
    assert _rsi(spark, [5.0] * 15) == 100.0


def test_closed_form_matches_recurrence_on_random_walks(spark):
    rng = random.Random(7)
    rows, expect = [], {}
    for t in range(6):
        for d, n in enumerate([15, 16, 40, 200, 390]):
            closes, c = [], 100.0
            for _ in range(n):
                c = round(c + rng.uniform(-1, 1), 2)
                closes.append(c)
            day = f"2024-01-{d + 2:02d}"
            rows += day_of(closes, ticker=f"T{t}", day=day)
            expect[(f"T{t}", day)] = wilder_rsi(closes)
    bars = make_bars(spark, rows)
    got = {(r.ticker, r.trade_date.isoformat()): r.rsi for r in op.intraday_rsi(bars).collect()}
    for k, v in expect.items():
        assert got[k] == pytest.approx(v, abs=1e-9), k
        assert 0.0 <= got[k] <= 100.0
    arr = op.ordered_closes(bars).select("ticker", "trade_date", op.rsi_of_array("all_closes").alias("rsi"))
    for r in arr.collect():
        assert r.rsi == pytest.approx(expect[(r.ticker, r.trade_date.isoformat())], abs=1e-9)


def test_other_periods(spark):
    closes = [100.0, 101.5, 100.2, 100.9, 102.0, 101.1, 103.3, 102.2]
    assert _rsi(spark, closes, period=3) == pytest.approx(wilder_rsi(closes, 3), abs=1e-12)
    assert _rsi(spark, closes, period=7) == pytest.approx(wilder_rsi(closes, 7), abs=1e-12)


def test_invariant_to_row_order_partitioning_and_price_scale(spark):
    rng = random.Random(11)
    closes = [round(50 + rng.uniform(-5, 5), 2) for _ in range(60)]
    rows = day_of(closes)
    base = _rsi(spark, closes)
    rng.shuffle(rows)
    shuffled = op.intraday_rsi(make_bars(spark, rows).repartition(5)).collect()[0].rsi
    assert shuffled == pytest.approx(base, abs=1e-12)
    scaled = _rsi(spark, [c * 8.0 for c in closes])
    assert scaled == pytest.approx(base, abs=1e-9)


def test_null_close_is_skipped(spark):
    closes = [float(i) for i in range(16)]
    rows = day_of(closes)
    rows.insert(5, ("AAA", "2024-01-02", 570 + 5, 4.0, None, 100))
    rows = [(t, d, m if i <= 5 else m + 1, o, c, v) for i, (t, d, m, o, c, v) in enumerate(rows)]
    r = op.intraday_rsi(make_bars(spark, rows)).collect()[0]
    assert r.rsi == 100.0


def test_array_form_handles_short_and_null(spark):
    df = spark.createDataFrame([([1.0, 2.0],), (None,)], "c array<double>")
    assert [r.r for r in df.select(op.rsi_of_array("c").alias("r")).collect()] == [None, None]
    df2 = spark.createDataFrame([([float(i) for i in range(15)],)], "c array<double>")
    assert df2.select(op.rsi_of_array("c").alias("r")).collect()[0].r == 100.0


@pytest.mark.parametrize("split", [1, 7, 60])
def test_split_day_sequence_is_identical(spark, split):
    rng = random.Random(17)
    rows = []
    for t in ("A", "B"):
        for d in ("2024-01-02", "2024-01-03"):
            closes = [round(100 + rng.uniform(-3, 3), 2) for _ in range(90)]
            rows += day_of(closes, ticker=t, day=d, start_minute=600)
    rows.append(("A", "2024-01-02", 640, 1.0, None, 5))        # a null close mid-day
    rows.append(("B", "2024-01-03", 650, 9.0, 9.5, 5))         # a timestamp tie
    bars = make_bars(spark, rows)
    cols = ["ticker", "trade_date", "timestamp", "close", "pos", "prev_close", "n_closes", "first_close"]
    base = sorted(tuple(r) for r in op.sequence_view(bars).where("pos < n_closes").select(*cols).collect())
    got = sorted(tuple(r) for r in op.sequence_view(bars, split).where("pos < n_closes").select(*cols).collect())
    assert got == base
    def rounded(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())
    assert rounded(op.indicators(bars)) == rounded(op.indicators(bars, split_minutes=split))


@pytest.mark.parametrize("split,block", [(None, 64), (None, 5), (7, 3)])
def test_merged_blocks_match_daily_bars(spark, split, block):
    rng = random.Random(41)
    rows = []
    for t in ("A", "B"):
        for d in ("2024-01-02", "2024-01-03"):
            rows += day_of([round(100 + rng.uniform(-3, 3), 2) for _ in range(40)], ticker=t, day=d, start_minute=600)
    rows.append(("A", "2024-01-02", 615, 1.0, None, 5))
    rows.append(("B", "2024-01-03", 620, 9.0, 9.5, 5))
    rows.append(("C", "2024-01-02", 600, 3.0, None, 2))      # a day with no close at all
    bars = make_bars(spark, rows)

    def rounded(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())
    cols = ["ticker", "trade_date", "day_open", "day_close", "day_high", "day_low", "day_volume", "bar_count", "rsi"]
    daily = op.merge_day(op.close_blocks(bars, block=block, split_minutes=split))
    assert rounded(daily.select(*cols)) == rounded(op.daily_bars(bars).select(*cols))
    assert sorted(op.validate_daily(daily).collect()) == sorted(op.validate_bars(bars).collect())


def _variants(bars):
    def rounded(df):
        return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)
    return rounded


@pytest.mark.parametrize("split", [1, 7, 60])
def test_split_keeps_rows_without_a_timestamp(spark, split):
    from conftest import day_of, make_bars
    bars = make_bars(spark, day_of([float(10 + i % 7) for i in range(20)]))
    bars = bars.unionByName(bars.limit(1).selectExpr("ticker", "trade_date", "CAST(NULL AS TIMESTAMP_NTZ) AS timestamp", "9D AS open",
                                                     "9D AS high", "9D AS low", "9D AS close", "200L AS volume"))
    rounded = _variants(bars)
    want = rounded(op.indicators(bars))
    assert want[0][7] == 21 and want[0][2] == 9.0 and rounded(op.indicators(bars, split_minutes=split)) == want
    assert rounded(op.pair_correlation(bars, split_minutes=split)) == rounded(op.pair_correlation(bars))


@pytest.mark.parametrize("split", [7, 60])
def test_split_over_midnight_and_a_clock_change(spark, split):
    from conftest import BAR_SCHEMA
    import datetime as dt
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        start = dt.datetime(2023, 11, 5, 3, 0)  # UTC; 23:00 of the day before there, clocks go back at 06:00 UTC
        rows = [("A", "2023-11-04", (start + dt.timedelta(minutes=6 * i)).isoformat() + "Z", float(100 + (i * 7) % 11)) for i in range(60)]
        bars = spark.createDataFrame(rows, "ticker string, d string, t string, close double").selectExpr(
            "ticker", "CAST(d AS DATE) AS trade_date", "CAST(t AS TIMESTAMP) AS timestamp", "close AS open", "close AS high",
            "close AS low", "close", "1L AS volume")
        rounded = _variants(bars)
        assert rounded(op.indicators(bars, split_minutes=split)) == rounded(op.indicators(bars))
        ntz = bars.withColumn("timestamp", F.expr("to_timestamp_ntz(date_format(timestamp, 'yyyy-MM-dd HH:mm:ss'))")).dropDuplicates(["timestamp"])
        assert rounded(op.indicators(ntz, split_minutes=split)) == rounded(op.indicators(ntz))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def _loop(closes, period=14):
    """The recurrence step by step, with its rounding."""
    gain = loss = 0.0
    for k in range(1, len(closes)):
        d = closes[k] - closes[k - 1]
        up, down = max(d, 0.0), max(-d, 0.0)
        if k < period:
            gain, loss = gain + up, loss + down
        elif k == period:
            gain, loss = (gain + up) / period, (loss + down) / period
        else:
            gain, loss = (gain * (period - 1) + up) / period, (loss * (period - 1) + down) / period
    return None if len(closes) <= period else 100.0 if loss == 0 else 100 - 100 / (1 + gain / loss)


def _days(spark, days):
    """Bars a second apart, one ticker per list of closes."""
    rows = [(f"T{t}", i, float(c)) for t, closes in enumerate(days) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "ticker string, i int, close double").selectExpr(
        "ticker", "DATE'2024-01-02' AS trade_date", "timestampadd(SECOND, i, TIMESTAMP_NTZ'2024-01-02 00:00:00') AS timestamp",
        "close AS open", "close AS high", "close AS low", "close", "1L AS volume")


@pytest.mark.parametrize("period", [14, 3, 4])
def test_any_length_equals_the_loop_split_and_unsplit(spark, period):
    rng = random.Random(23)
    walk = [100.0]
    for _ in range(13_000):
        walk.append(walk[-1] + rng.choice([-0.25, 0.0, 0.5, -0.5]))
    wave = [100.0 + (i % 2) for i in range(30)]
    days = [wave + [101.0] * 12_000,                       # moves, then flat beyond the range of doubles
            wave + [101.0] * 5_000, wave + [101.0] * 300,
            walk,
            [1.0 + i for i in range(40)] + [40.0] * 11_000 + [39.0],   # the gains all lie before the flat stretch
            [1.0 + i for i in range(40)] + [40.0] * 11_000 + [41.0],
            [50.0 - i for i in range(40)] + [11.0] * 11_000 + [12.0] + [12.0] * 400,
            [5.0] * 9_000, [7.0] * period, [7.0] * (period + 1), [3.0, 2.0] + [2.0] * period]
    bars = _days(spark, days)
    want = {f"T{t}": _loop(c, period) for t, c in enumerate(days)}
    for kw in ({}, {"split_minutes": 10}, {"split_minutes": 60, "block": 8}):
        got = {r.ticker: r.rsi for r in op.intraday_rsi(bars, period, **kw).collect()}
        assert got.keys() == want.keys()
        for t, v in want.items():
            assert got[t] == (None if v is None else pytest.approx(v, abs=1e-9)), (t, kw)
    for split in (None, 10):
        got = {r.ticker: r.rsi for r in op.indicators(bars, period, split_minutes=split).collect()}
        assert all(got[t] == (None if v is None else pytest.approx(v, abs=1e-9)) for t, v in want.items())


def test_rsi_builds_no_array(spark):
    from barsmith.plans.shape import physical_plan
    bars = _days(spark, [[1.0, 2.0, 3.0]])
    for split in (None, 60):
        plan = physical_plan(op.intraday_rsi(bars, split_minutes=split))
        assert "collect_list" not in plan and "aggregate(" not in plan
