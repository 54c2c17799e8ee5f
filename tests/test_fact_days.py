"""The runner's fact by status and day: increments, pruning, weekly revenue."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart.plans import marts
from starmart.plans.runner import Lake, LakeConfig, main
from starmart.session import scratch_dir
from starmart.sources.fixtures import order_events
from tests.conftest import SF_SMALL

YEAR = 1995


def loads(spark, fact_days):
    lake = Lake(spark, LakeConfig(scratch_dir(spark, "lake_d"), fact_days))
    # three months and one early 1998 load keep the number of day folders small
    ev = order_events(spark, SF_SMALL).where("month(event_ts) in (1, 2, 3) and year(event_ts) in (1994, 1995)")
    first = F.col("event_ts") < F.lit(dt.datetime(YEAR, 2, 1)).cast("timestamp_ntz")
    for load, incremental in ((ev.where(first), None), (ev.where(~first), True)):
        lake.append_bronze(load)
        lake.run_all(incremental=incremental)
    return lake


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_day_layout_holds_the_same_fact(spark):
    by_day, by_status = loads(spark, True), loads(spark, False)
    fact, plain = by_day.table(by_day.cfg.fact_orders), by_status.table(by_status.cfg.fact_orders)
    assert rows(fact.select(*plain.columns)) == rows(plain) and plain.count() > 0
    assert fact.where("event_day <> cast(event_ts as date) or event_day is null").count() == 0
    assert {r.status for r in fact.select("status").distinct().collect()} == {r.status for r in plain.select("status").distinct().collect()}
    weeks = rows(by_day.revenue_by_week(YEAR))
    assert weeks == rows(by_status.revenue_by_week(YEAR)) and weeks
    sold = plain.where(marts.is_revenue("status") & (F.year("event_ts") == YEAR))
    assert sum(r[3] for r in weeks) == sold.count()
    plan = by_day.revenue_by_week(YEAR)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert by_day.revenue_by_week(1900).count() == 0


def test_cli_asks_for_the_year(spark):
    with pytest.raises(SystemExit):
        main(["--lake", scratch_dir(spark, "lake_e"), "--stage", "revenue_by_week"])
