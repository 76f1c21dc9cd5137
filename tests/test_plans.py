"""Properties of the physical plans that matter at scale."""

from pathlib import Path

import pytest

from neudrift.operators.resample import PAIR, with_bucket
from neudrift.plans.queries import QUERIES
from neudrift.session import workspace
from neudrift.sources.events import observations

SF = "/root/testdata/sf0.001"


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    df._jdf.collectToPython()
    plan = planned(df)
    return plan[plan.index("== Final Plan =="):].split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins_and_no_python_in_the_plan(spark, name):
    plan = planned(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas", "CollectLimit"):
        assert operator not in plan


def test_resampling_shuffles_once(spark):
    plan = executed(QUERIES["resample_60s"](spark, SF))
    assert plan.count("Exchange") == 1 and "hashpartitioning(base" in plan


def test_bucket_sizes_are_counted_from_two_columns(spark):
    counted = with_bucket(observations(spark, SF).select(*PAIR, "time"), "60s").groupBy(*PAIR, "bucket").count()
    plan = planned(counted)
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


def test_dashboard_resamples_once_and_limits_before_the_shuffle(spark):
    plan = executed(QUERIES["component_series"](spark, SF))
    assert plan.count("FileScan parquet [event_id") == 1 and "ReusedExchange" in plan
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert any("Partial" in line for line in limits)


@pytest.mark.parametrize("name", ["newest_files", "one_min_table", "series_levels"])
def test_rank_limits_run_before_the_shuffle(spark, name):
    plan = planned(QUERIES[name](spark, SF))
    assert "row_number(), " in plan and "Partial" in plan


@pytest.mark.parametrize("name", ["clean_observations", "preset_slices", "archive_merge"])
def test_filters_reach_the_scan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = planned(QUERIES[name](spark, SF))
    assert "IsNotNull(props)" in plan or "IsNotNull(value)" in plan
    if name == "preset_slices":
        assert "GreaterThanOrEqual(ts" in plan


WRITING = ["load_report", "scan_daily_files", "listed_files", "archive_roundtrip", "median_file_roundtrip", "archive_days",
           "bucketed_table", "written_order", "table_metadata", "late_rows", "stream_load_table"]


@pytest.mark.parametrize("name", WRITING)
def test_queries_leave_no_folders(spark, name):
    """What a query writes to read it back is gone when it returns; checkpoints are Spark's to delete."""
    place = Path(workspace(spark).removeprefix("file:"))
    before = {p.name for p in place.iterdir()}
    found = QUERIES[name](spark, SF)
    assert found.count() >= 0
    assert {p.name for p in place.iterdir()} - before <= {p.name for p in place.glob("rdd-*")}
