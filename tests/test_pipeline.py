import pytest

from barsmith.plans.compare import duck_connection
from barsmith.plans.oracle import oracle_sql
from barsmith.plans.pipeline import PipelineConfig, run_pipeline
from barsmith.sources import fixture_bars

SF = "/root/testdata/sf0.01"


def test_pipeline_end_to_end(spark):
    out = run_pipeline(spark, fixture_bars(spark, SF))
    con, twins = duck_connection(SF), oracle_sql()
    assert out["total_rows"] == con.sql(twins["bar_count_total"]).fetchall()[0][0]
    assert out["dropped_rows"] == 0
    assert out["written"]["rows"] == 110 and out["written"]["files"] >= 1
    assert out["regime_changes"] == con.sql(twins["regime_change_count"]).fetchall()[0][0]
    assert out["validation"].count() == 5
    assert len(out["top_pairs"]) == len(con.sql(twins["top_pairs"]).fetchall())


def test_pipeline_calendar_lag_and_partitioned_output(spark):
    out = run_pipeline(spark, fixture_bars(spark, SF),
                       PipelineConfig(calendar_lag=True, partition_by=["ticker", "signal_regime"], stage=False))
    counts = duck_connection(SF).sql(oracle_sql()["transition_counts"])
    assert out["regime_changes"] == dict(zip(counts.columns, counts.fetchall()[0]))["calendar_lag_changes"]
    assert out["written"]["rows"] == 110


@pytest.mark.parametrize("cfg", [PipelineConfig(), PipelineConfig(split_minutes=60), PipelineConfig(split_minutes=7)])
def test_pipeline_reports_dropped_rows(spark, cfg):
    from conftest import day_of, make_bars
    bars = make_bars(spark, day_of([float(10 + i % 7) for i in range(20)]))
    keyless = bars.limit(3).selectExpr("CAST(NULL AS STRING) AS ticker", *bars.columns[1:])
    out = run_pipeline(spark, bars.unionByName(keyless), cfg)
    assert (out["dropped_rows"], out["total_rows"]) == (3, 20)
