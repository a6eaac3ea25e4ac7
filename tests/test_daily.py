import random

from conftest import day_of, make_bars
from pyspark.sql import functions as F

from barsmith import operators as op


def _one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_open_is_earliest_close_is_latest_after_shuffle(spark):
    rows = day_of([10.0, 11.0, 12.0, 9.0, 13.0])
    rows[0] = ("AAA", "2024-01-02", 570, 7.5, 10.0, 100)
    random.Random(3).shuffle(rows)
    r = _one(op.daily_ohlcv(make_bars(spark, rows).repartition(3)))
    assert r.day_open == 7.5 and r.day_close == 13.0
    assert r.day_high == 13.0 and r.day_low == 7.5
    assert r.day_volume == 500 and r.bar_count == 5


def test_timestamp_ties_take_min_open_and_max_close(spark):
    rows = [("AAA", "2024-01-02", 570, 5.0, 6.0, 1), ("AAA", "2024-01-02", 570, 4.0, 7.0, 1),
            ("AAA", "2024-01-02", 600, 6.0, 9.0, 1), ("AAA", "2024-01-02", 600, 7.0, 8.0, 1)]
    r = _one(op.daily_ohlcv(make_bars(spark, rows)))
    assert r.day_open == 4.0 and r.day_close == 9.0


def test_unique_timestamp_mode_agrees_when_unique(spark):
    bars = make_bars(spark, day_of([1.0, 2.0, 3.0, 2.5]) + day_of([5.0, 4.0], ticker="BBB"))
    a = sorted(op.daily_ohlcv(bars).collect())
    b = sorted(op.daily_ohlcv(bars, assume_unique_ts=True).collect())
    assert a == b


def test_ordered_closes_skip_nulls_and_keep_time_order(spark):
    rows = day_of([1.0, 2.0, 3.0, 4.0])
    rows[2] = ("AAA", "2024-01-02", rows[2][2], 2.0, None, 100)
    random.Random(1).shuffle(rows)
    r = _one(op.ordered_closes(make_bars(spark, rows)))
    assert r.all_closes == [1.0, 2.0, 4.0]
    d = _one(op.closes_digest(op.ordered_closes(make_bars(spark, rows))))
    assert (d.n_closes, d.first_close, d.last_close, d.sum_closes) == (3, 1.0, 4.0, 7.0)


def test_validate_counts_bars_and_days(spark):
    rows = day_of([1.0, 2.0]) + day_of([3.0], day="2024-01-03") + day_of([1.0], ticker="BBB")
    got = [tuple(r) for r in op.validate_bars(make_bars(spark, rows)).collect()]
    assert got == [("AAA", 3, 2), ("BBB", 1, 1)]
    assert _one(op.bar_count_total(make_bars(spark, rows))).total_rows == 4
    assert sorted(r.ticker for r in op.distinct_tickers(make_bars(spark, rows)).collect()) == ["AAA", "BBB"]


def test_mapping_uses_every_event(spark):
    from barsmith.sources import fixture_bars, load_table
    sf = "/root/testdata/sf0.01"
    events = load_table(spark, sf, "events")
    bars = fixture_bars(spark, sf)
    assert bars.count() == events.selectExpr("event_type", "date_trunc('MINUTE', ts)").distinct().count()
    cents = events.selectExpr("sum(CAST(ROUND(value * 100) AS BIGINT)) AS c", "count(*) AS n").first()
    got = bars.selectExpr("sum(volume / CASE WHEN dayofmonth(trade_date) % 5 = 0 THEN 3 ELSE 1 END) AS c",
                          "sum((close - open) * 100) AS step").first()
    assert round(got.c) == cents.c                      # every event's volume
    assert round(got.step) == cents.c - 5000 * cents.n   # and step, whatever its weekday
    days = bars.selectExpr("dayofweek(trade_date) AS d", "dayofweek(timestamp) AS t").distinct().collect()
    assert {r.d for r in days} == {2, 3, 4, 5, 6} and {r.t for r in days} == {1, 2, 3, 4, 5, 6, 7}


def test_enforce_types_nulls_nan_and_infinite_prices(spark):
    from barsmith.sources import enforce_bar_types
    rows = [("A", "2024-01-02", "2024-01-02 09:30:00", float("nan"), float("inf"), float("-inf"), 1.5, 7)]
    df = spark.createDataFrame(rows, "ticker string, trade_date string, timestamp string, open double, "
                                     "high double, low double, close double, volume int")
    r = enforce_bar_types(df).collect()[0]
    assert (r.open, r.high, r.low, r.close, r.volume) == (None, None, None, 1.5, 7)
    assert str(r.trade_date) == "2024-01-02" and r.timestamp.hour == 9


def test_read_bars_from_path_types_and_null_keys(spark):
    from barsmith.session import staging_path
    from barsmith.sources import null_key_rows, read_bars
    rows = [("A", "2024-01-02", "2024-01-02 09:30:00", "10.0", 10.5, 9.5, 10.2, 100),
            ("A", "2024-01-02", None, "10.2", 10.4, 10.1, 10.3, 50),
            (None, "2024-01-02", "2024-01-02 09:31:00", "10.3", 10.6, 10.2, 10.4, 70)]
    raw = spark.createDataFrame(rows, "ticker string, trade_date string, timestamp string, open string, "
                                      "high double, low double, close double, volume int")
    path = staging_path(spark, "test-bars")
    raw.write.parquet(path)
    bars = read_bars(spark, path)
    assert [f.dataType.simpleString() for f in bars.schema.fields] == \
        ["string", "date", "timestamp", "double", "double", "double", "double", "bigint"]
    assert bars.count() == 1
    assert null_key_rows(spark.read.parquet(path)).collect()[0].null_key_rows == 2
    assert read_bars(spark, path, drop_null_keys=False).count() == 3


def test_day_bitmaps_count_and_merge_like_sets(spark):
    rng = random.Random(5)
    days = ["2024-01-02", "2024-01-03", "1950-01-01", "1949-12-31", "2039-09-18", "2039-09-19", "0001-01-01", "9999-12-31", None]
    rows = [(rng.choice("ABC"), rng.choice(days), 570 + i, 1.0, 1.0, 1) for i in range(150)] + [("N", None, 570, 1.0, 1.0, 1)]
    schema = "ticker string, trade_date string, timestamp int, open double, close double, volume int"
    bars = spark.createDataFrame(rows, schema).withColumn("trade_date", F.col("trade_date").cast("date"))
    want = sorted((t, sum(r[0] == t for r in rows), len({r[1] for r in rows if r[0] == t} - {None})) for t in "ABCN")
    assert [tuple(r) for r in op.validate_bitmaps(op.day_bitmaps(bars)).collect()] == want
    parts = [op.day_bitmaps(bars.where(f"timestamp % 3 = {k}")) for k in range(3)]
    two = op.merge_day_bitmaps(parts[0].unionByName(parts[1]))
    merged = op.merge_day_bitmaps(two.unionByName(parts[2]))
    assert [tuple(r) for r in op.validate_bitmaps(merged).collect()] == want
    assert op.validate_bitmaps(op.day_bitmaps(bars.limit(0))).count() == 0
