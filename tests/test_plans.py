"""Physical-plan properties the design relies on."""

import pytest

from starmart.plans.catalog import registered
from starmart.plans import marts
from starmart.plans.catalog import StarBuild
from starmart.plans.runner import Lake, LakeConfig
from starmart.session import scratch_dir
from starmart.sources.fixtures import order_events
from tests.conftest import SF_SMALL

# these write files when called; their read-back plans are trivial scans
WRITES = {"bronze_batch", "bronze_stream", "fact_by_status", "fact_by_day", "load_audit",
          "silver_stream"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registered()) - WRITES))
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = _plan(registered()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_dedup_is_partial_then_final_window_limit(spark):
    plan = StarBuild(spark, SF_SMALL).silver._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_fact_scan_prunes_status_partitions_and_columns(spark):
    lake = Lake(spark, LakeConfig(scratch_dir(spark, "lake_p")), hot_share=None)
    lake.append_bronze(order_events(spark, SF_SMALL))
    lake.run_all()
    fact = lake.table(lake.cfg.fact_orders)
    df = marts.sales_summary(fact, lake.table(lake.cfg.dim_customer),
                             lake.table(lake.cfg.dim_product))
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [NOT status" in text
    assert "ReadSchema: struct<customer_key:string,product_key:string,order_total:double>" in text
