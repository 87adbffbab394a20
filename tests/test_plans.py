"""Shape of the physical plans: no nested-loop or cartesian joins, filters at the scan."""

import pytest

import __spark_entry__ as entry
from tidemark.sources.sample import Sample

RELATIONAL = ["k1_market_context", "k3_theme_context", "k5_macro_context", "k9_domestic_flow", "k10_event_calendar", "k12_forecast_targets", "k18_component_scores", "j7_spine_grid", "j12_forward_asof",
              "j13_monthly_asof", "j14_threshold_by_year", "j15_backward_asof", "j15_latest_session_snapshot", "j21_walk_forward_folds", "a8_spearman_whole_table", "a10_quantiles_whole_table", "w35_forward_fill"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_nested_loops(spark, name):
    text = plan(entry.queries()[name](spark, "/root/testdata/sf0.001"))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_scan_reads_only_needed_columns(spark):
    text = plan(entry.queries()["k5_macro_context"](spark, "/root/testdata/sf0.001"))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in text


def test_date_filter_reaches_the_scan(spark, tmp_path):
    from tidemark.sources.tables import price_panel

    Sample(spark, "/root/testdata/sf0.001").stock_prices.write.parquet(str(tmp_path / "p"))
    text = plan(price_panel(spark.read.parquet(str(tmp_path / "p")), ["000001"], "1998-01-01", "2000-12-31"))
    assert "GreaterThanOrEqual(date," in text and "In(ticker" in text or "EqualTo(ticker" in text
