import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from barsmith import operators as op
from barsmith.session import staging_path
from barsmith.sources import read_signals, verify_write, write_signals

REPORT_SCHEMA = ("ticker string, trade_date date, day_open double, day_close double, day_high double, "
                 "day_low double, day_volume bigint, rsi double, signal_regime string, regime_changed boolean")


def _report(spark):
    rows = []
    for t, vol in (("A", 5), ("B", 50), ("C", 20), ("D", 20), ("E", 1)):
        for i, day in enumerate(("2024-01-02", "2024-01-03")):
            o, c = 10.0 + i, 10.5 + i if t != "C" else 9.0
            regime = ["BUY", "SELL"][i] if t != "E" else "UNKNOWN"
            rsi = None if t == "E" else 25.0 + 50 * i
            rows.append((t, dt.date.fromisoformat(day), o, c, max(o, c), min(o, c), vol, rsi, regime, i == 1))
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def test_top_tickers_breaks_ties_by_ticker(spark):
    got = [(r.ticker, r.total_vol) for r in op.top_tickers(_report(spark)).collect()]
    assert got == [("B", 100), ("C", 40), ("D", 40), ("A", 10), ("E", 2)]
    assert [r.ticker for r in op.top_tickers(_report(spark), 2).collect()] == ["B", "C"]


def test_ohlcv_feed_and_direction(spark):
    rows = op.ohlcv_feed(_report(spark), 3).collect()
    assert sorted({r.ticker for r in rows}) == ["B", "C", "D"]
    assert {(r.ticker, r.direction) for r in rows} == {("B", "UP"), ("C", "DOWN"), ("D", "UP")}


def test_rsi_feed_bands(spark):
    rows = op.rsi_feed(_report(spark), 5).collect()
    bands = {(r.ticker, r.rsi): r.rsi_band for r in rows}
    assert bands[("A", 25.0)] == "OVERSOLD" and bands[("A", 75.0)] == "OVERBOUGHT"
    assert bands[("E", None)] is None


def test_regime_matrix_fixed_dates_and_fill(spark):
    dates = ["2024-01-02", "2024-01-03", "2024-01-04"]
    m = op.regime_matrix(_report(spark), dates=dates).collect()
    assert [r.ticker for r in m] == ["A", "B", "C", "D", "E"]
    assert m[0]["2024-01-02"] == 1.0 and m[0]["2024-01-03"] == 5.0 and m[0]["2024-01-04"] is None
    assert m[4]["2024-01-02"] == 3.0
    labels = op.regime_matrix(_report(spark), dates=dates, value="label").collect()
    assert labels[0]["2024-01-04"] == "" and labels[4]["2024-01-03"] == "UNKNOWN"


def test_timeline_order(spark):
    rows = op.regime_timeline(_report(spark)).collect()
    assert [(r.trade_date.isoformat(), r.ticker) for r in rows][:3] == \
        [("2024-01-02", "A"), ("2024-01-02", "B"), ("2024-01-02", "C")]


def test_write_roundtrip_is_lossless(spark):
    rep = _report(spark)
    target = staging_path(spark, "test-plain")
    write_signals(rep.withColumn("arr", F.array(F.lit(1.0))), target, files=2)
    back = read_signals(spark, target, schema=rep.schema)
    assert back.exceptAll(rep).count() == 0 and rep.exceptAll(back).count() == 0
    v = verify_write(back).collect()[0]
    assert v.rows == 10 and 1 <= v.files <= 2
    assert verify_write(back, max_files=2).collect()[0].files_within_limit is True


def test_partitioned_write_roundtrip(spark):
    rep = _report(spark)
    target = staging_path(spark, "test-part")
    write_signals(rep, target, partition_by=["ticker", "signal_regime"])
    back = read_signals(spark, target, schema=rep.schema)
    assert back.columns == rep.columns
    assert back.exceptAll(rep).count() == 0 and rep.exceptAll(back).count() == 0
    pruned = back.where(F.col("ticker") == "A")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        pruned.explain("formatted")
    scan = [line for line in buf.getvalue().splitlines() if line.startswith("PartitionFilters")]
    assert scan and "ticker" in scan[0] and "= A" in scan[0], buf.getvalue()   # partition pruning
    assert pruned.count() == 2


def test_table_roundtrip_keeps_the_column_order(spark):
    rep = _report(spark)
    for name, by in (("barsmith_test_plain", None), ("barsmith_test_part", ["ticker", "signal_regime"])):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        write_signals(rep, name, partition_by=by)
        back = read_signals(spark, name, schema=rep.schema)
        assert back.columns == rep.columns
        assert back.exceptAll(rep).count() == 0 and rep.exceptAll(back).count() == 0
        spark.sql(f"DROP TABLE {name}")


def test_files_follow_the_records(spark):
    target = staging_path(spark, "test-many")
    write_signals(_report(spark), target, max_records_per_file=3)
    assert verify_write(read_signals(spark, target)).first().files >= 4
