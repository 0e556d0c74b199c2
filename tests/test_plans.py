"""Plan-shape checks: no cartesian products, no Python evaluation, filters reach the scan."""
import os
import tempfile

import pytest

import __spark_entry__ as E
from marketlens.registry import REGISTRY
from marketlens.plans.search_ads import campaign_performance_summary
from marketlens.sources.catalog import read_tables
from marketlens.sources.roles import ADS_AS_OF, DriverTables
from marketlens.sources.sinks import publish

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_no_cartesian_or_python(spark, key):
    plan = _plan(E.queries()[key](spark, SF))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{key}: {bad}"


def test_period_filter_and_columns_reach_the_scan(spark):
    """On real-shaped storage (stats partitioned by date) the 30-day predicate prunes partitions
    and only the referenced columns are read."""
    root = tempfile.mkdtemp(prefix="tables-")
    dt = DriverTables(spark, SF)
    publish(dt["campaign_stats"], os.path.join(root, "campaign_stats"), partition_by=["date"])
    for name in ["campaign_history", "account_history"]:
        publish(dt[name], os.path.join(root, name))
    t = read_tables(spark, root)
    df = campaign_performance_summary(t, ADS_AS_OF)
    plan = _plan(df)
    scan = [line for line in plan.splitlines() if "campaign_stats" in line and "FileScan" in line][0]
    assert "PartitionFilters: [isnotnull(date" in scan and "2024-03-31" in scan
    assert "video_views" not in scan  # unused stats columns are pruned
    assert df.count() > 0


def test_rank_plans_split_by_a_scalar_subquery(spark):
    plan = _plan(E.queries()["keyword_top_performers"](spark, SF))
    assert "Subquery" in plan


def test_plans_default_to_the_current_date(spark):
    import datetime as dt
    from marketlens.plans import search_ads
    t = DriverTables(spark, SF)
    today = spark.sql("select current_date()").first()[0]
    moved = t["campaign_stats"].selectExpr("*").withColumn("date", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(today - dt.timedelta(days=3)))
    from marketlens.streaming import OverlayTables
    assert search_ads.campaign_performance_summary(OverlayTables(t, {"campaign_stats": moved})).count() > 0
    assert search_ads.campaign_performance_summary(t).count() == 0  # the fixture ends long before today
