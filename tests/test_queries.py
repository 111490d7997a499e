"""The registry, and a sample of its queries against their SQL on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from compare import rows_of
from tests.conftest import SF

SAMPLE = [
    "clean_readings", "rolling_mean_var", "usage_ratios", "tick_scope_features", "one_hot_profile", "balanced_sample",
    "stratified_split_counts", "risk_scores", "risk_scores_by_tick", "efficiency_by_area", "segment_labels", "overview",
    "report_tables", "score_histogram", "json_ingest", "weather_parse", "forecast_compare", "drift_report", "ks_drift",
    "alert_feed", "top_reasons",
]


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.oracle_sql()) >= 110


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["area", "avg_risk_score", "critical_count", "high_count", "meter_count"] and df.count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, tables, name):
    df = entry.queries()[name](spark, SF)
    result = tables.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, result.fetchall())


@pytest.mark.parametrize("name", ["risk_scores", "consumer_profile", "weather_enrich", "alert_feed", "mean_shift"])
def test_plans_have_no_cross_joins(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    from pyspark.sql import functions as F

    from meterlake.sources.tables import meter_readings

    df = meter_readings(spark, SF).where(F.col("consumption_kwh") > 100).select("meter_id", "consumption_kwh")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(value,100.0)" in plan and "ReadSchema: struct<user_id:bigint,value:double>" in plan


def test_tasks_need_no_copy_of_the_package(tmp_path):
    """Started elsewhere and without PYTHONPATH, Python workers still run the package's functions."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {root!r}); import __spark_entry__ as e; from meterlake.plans.session import build_session;"
        "print('rows', e.queries()['isolation_forest_scores'](build_session('2', 2), '/root/testdata/sf0.001').count())"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 1000" in done.stdout, done.stderr[-2000:]
