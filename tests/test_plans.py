"""What the plans of registered queries must and must not contain."""

import pytest
from pyspark.sql import functions as F

from tradewatch import queries as entry
from tradewatch.plans.detect import enriched_alerts
from tradewatch.queries import catalog, views

SF = "/root/testdata/sf0.01"
WRITERS = {"stream_ingest", "stream_detect", "landed_pages", "layout_roundtrip", "transcript_files", "column_added", "series_refreshed", "intent_file"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - WRITERS))
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    for word in ("PythonUDF", "ArrowEval", "BatchEval", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoop"):
        assert word not in plan, word


@pytest.mark.parametrize("name", ["recent_trades", "rolling_baseline", "unusual_trades"])
def test_time_bounds_reach_the_scan(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "GreaterThan(ts" in plan and "LessThanOrEqual(ts" in plan


def test_baseline_reads_only_its_columns(spark):
    plan = plan_of(entry.queries()["rolling_baseline"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp,user_id:bigint,value:double,props:string>" in plan


def test_fact_table_is_aggregated_before_its_only_shuffle(spark):
    plan = plan_of(entry.queries()["rolling_baseline"](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_avg" in plan


def test_parsing_happens_below_a_generator(spark):
    plan = plan_of(entry.queries()["parse_frames_a"](spark, SF))
    assert plan.count("from_json") <= 4


def test_dimensions_are_joined_to_candidates_only(spark):
    trades = views.trades(spark, SF)
    dims = (views.markets_a(spark, SF), views.markets_b(spark, SF), views.series(spark, SF))
    plan = enriched_alerts(trades, *dims, views.latest(trades, "ts"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") >= 2


def test_days_of_stored_tables_are_pruned(spark, tmp_path):
    from datetime import timedelta

    from tradewatch.plans.detect import DetectParams, alerts_since
    from tradewatch.plans.requests import recent_debates
    from tradewatch.sources.tables import append_alerts, append_debates, append_trades, read_table
    from tradewatch import schemas
    from tradewatch.streaming import jobs

    trades = views.trades(spark, SF)
    as_of = views.latest(trades, "ts")
    append_alerts(views.alerts(spark, SF), str(tmp_path / "alerts"))
    append_debates(views.debates(spark, SF), str(tmp_path / "debates"))
    append_trades(trades, str(tmp_path / "trades"))
    alerts = jobs.alerts_table(spark, str(tmp_path / "alerts"))
    debates = read_table(spark, str(tmp_path / "debates"), schemas.DEBATES, "batch_id string, started_date date")
    asked = spark.createDataFrame([(as_of,)], "requested_at timestamp")
    for df in (alerts_since(alerts, as_of - DetectParams().lookback), recent_debates(debates, asked, timedelta(hours=3))):
        plan = plan_of(df)
        filters = plan[plan.index("PartitionFilters: [") :].split("]")[0]
        assert "_date" in filters


@pytest.mark.parametrize("name", ["normalise_markets_a", "normalise_markets_b", "normalise_series"])
def test_payloads_of_one_file_are_parsed_by_many_tasks(spark, name):
    rows = entry.queries()[name](spark, SF)
    assert rows.select(F.spark_partition_id()).distinct().count() >= spark.sparkContext.defaultParallelism


def test_a_refresh_stages_markets_by_many_tasks(spark):
    staged = catalog._refreshed_a(spark, SF).staged
    assert len(staged.inputFiles()) >= spark.sparkContext.defaultParallelism
