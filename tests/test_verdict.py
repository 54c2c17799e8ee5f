"""Late files, ties, money, zones and MERGE rules."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from starmart.functions.exprs import money_sum
from starmart.operators.dedup import dedup_latest
from starmart.operators.scd2 import merge_into, scd2_apply
from starmart.plans.runner import Lake, LakeConfig
from starmart.session import scratch_dir
from starmart.sources.bronze import typed_events


def test_a_file_that_appears_late_with_old_times_is_read(spark, bronze_rows, tmp_path):
    lake = Lake(spark, LakeConfig(scratch_dir(spark, "lake_late")))
    lake.append_bronze(bronze_rows(*({"event_id": f"e{i}"} for i in range(20))))
    lake.build_silver()
    before = {os.path.join(d, f) for d, _, fs in os.walk(lake.cfg.bronze) for f in fs}
    lake.append_bronze(bronze_rows({"event_id": "late"}))
    for d, _, files in os.walk(lake.cfg.bronze):
        for f in files:
            if f.endswith(".parquet") and os.path.join(d, f) not in before:
                os.utime(os.path.join(d, f), (1, 1))
    assert lake.gate(increment_only=True)["total"] == 1
    assert lake.build_silver()["operation"] == "MERGE"
    merged = {r.event_id for r in lake.silver().collect()}
    assert "late" in merged and len(merged) == 21
    lake.build_silver(incremental=False)
    assert {r.event_id for r in lake.silver().collect()} == merged


def test_ties_that_differ_in_region_only_have_one_winner(bronze_rows):
    rows = [{"customer_region": "East"}, {"customer_region": "West"}]
    for order in (rows, rows[::-1]):
        assert [r.customer_region for r in dedup_latest(bronze_rows(*order), ["event_id"]).collect()] == ["West"]


def test_money_is_rounded_once(spark):
    assert spark.range(1000).select(money_sum(F.lit(0.004)).alias("s")).first().s == 4.0


def test_zone_offsets_are_applied(spark):
    from starmart.functions.schemas import EVENT_SCHEMA
    stamps = ["2026-01-01T23:30:00-05:00", "2026-01-01T10:00:00", "nope"]
    raw = spark.createDataFrame([{"event_id": str(i), "event_ts": x} for i, x in enumerate(stamps)], EVENT_SCHEMA)
    got = [r.event_ts for r in typed_events(raw).orderBy("event_id").collect()]
    assert got == [dt.datetime(2026, 1, 2, 4, 30), dt.datetime(2026, 1, 1, 10), None]


def test_merge_refuses_several_source_rows_of_a_key(spark):
    t = spark.createDataFrame([("a", 1)], "k string, v int")
    s = spark.createDataFrame([("a", 2), ("a", 3)], "k string, v int")
    with pytest.raises(Exception, match="several rows of one k"):
        merge_into(t, s, "k", matched_set={"v": F.col("s_v")}).collect()
    one = merge_into(t, s.limit(1), "k", matched_set={"v": F.col("s_v")}).collect()
    assert [tuple(r) for r in one] == [("a", 2)]


def test_a_null_current_flag_stays_in_the_dimension(spark):
    dim = spark.createDataFrame([("k", "c", "n", "r", dt.date(2026, 1, 1), None, None)],
                                "customer_key string, customer_id string, customer_name string, customer_region string, "
                                "start_date date, end_date date, is_current boolean")
    none = spark.createDataFrame([], "customer_id string, customer_name string, customer_region string, effective_date date, first_seen date")
    assert scd2_apply(dim, none).count() == 1


def test_sql_marts_shuffle_the_fact_by_pairs_only(spark):
    from starmart.plans import marts
    fact = spark.createDataFrame([("c", "p", 1.5, "NEW")], "customer_key string, product_key string, order_total double, status string")
    dc = spark.createDataFrame([("c", "East", True)], "customer_key string, customer_region string, is_current boolean")
    dp = spark.createDataFrame([("p", "Toys")], "product_key string, product_category string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (marts.revenue_top10_sql(fact, dc, dp, 0), marts.sales_summary_by_region(fact, dc, dp, "East", 0)):
            assert [tuple(r) for r in df.collect()] == [("East", "Toys", 1.5, 1)]
            plan = df._jdf.queryExecution().sparkPlan().toString()
            assert plan.count("HashAggregate") == 6
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert plan.index("Join Inner") < plan.rindex("Aggregate [customer_key")  # sums stand below the joins
        views = spark.catalog.listTables()
        for df in (marts.revenue_top10_sql(fact, dc, dp), marts.sales_summary_by_region(fact, dc, dp, "East")):
            assert [tuple(r) for r in df.collect()] == [("East", "Toys", 1.5, 1)]
            plan = df._jdf.queryExecution().sparkPlan().toString()  # measured small: one aggregate over a scan
            assert plan.count("BroadcastHashJoin") == 2 and plan.count("HashAggregate") == 2 and "SortMergeJoin" not in plan
        assert spark.catalog.listTables() == views
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_serving_reads_published_gold_and_an_empty_change_set_publishes_nothing(spark, bronze_rows):
    from starmart.sources import tables
    lake = Lake(spark, LakeConfig(scratch_dir(spark, "lake_serve")))
    lake.append_bronze(bronze_rows(*({"event_id": f"e{i}"} for i in range(5))))
    top = lake.run_all().first()
    assert [tuple(r) for r in lake.sales_summary(top.customer_region).select("revenue", "order_count").collect()] == [(top.revenue, 5)]
    assert lake.sales_summary().count() == 1 and lake.sales_summary("nowhere").count() == 0
    assert lake.customer_ltv("unknown").first().ltv == 0.0
    lake.append_bronze(bronze_rows({"event_id": "again"}))
    assert lake.run_all(incremental=True).first().orders == 6
    assert tables.versions(spark, lake.cfg.dim_customer) == [0]


def test_a_build_lists_files_without_opening_them_and_reads_only_new_ones(spark, bronze_rows):
    from starmart.plans.silver import files_of, read_files, unread
    from starmart.sources import tables
    lake = Lake(spark, LakeConfig(scratch_dir(spark, "lake files")))
    for region in ("MIDDLE EAST", "a=b/c[1]"):
        lake.append_bronze(bronze_rows({"event_id": region, "customer_region": region}))
    lake.build_silver()
    files = files_of(spark, [lake.cfg.bronze])
    assert "FileScan binaryFile" in files._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in spark._jvm.PythonSQLUtils.explainString(files._jdf.queryExecution(), "formatted")
    assert unread(files, tables.read(spark, lake.cfg.silver_inputs)) == {}
    every = unread(files, files.limit(0))
    assert sorted(r.customer_region for r in read_files(spark, every)[0].collect()) == ["MIDDLE EAST", "a=b/c[1]"]


def test_an_empty_increment_proceeds(spark, bronze_rows):
    lake = Lake(spark, LakeConfig(scratch_dir(spark, "lake_empty")))
    assert lake.gate(increment_only=True)["decision"] == "quarantine"  # no bronze at all
    lake.append_bronze(bronze_rows({}))
    assert lake.run_all(gate_increment_only=True) is not None
    again = lake.gate(increment_only=True)
    assert (again["decision"], again["total"], again["null_rate"]) == ("proceed", 0, 0.0)
    assert lake.run_all(gate_increment_only=True).count() == 1


def test_lifetime_values_are_published_by_bucket(spark, bronze_rows):
    from starmart.sources import tables
    lake = Lake(spark, LakeConfig(scratch_dir(spark, "lake_ltv")))
    lake.append_bronze(bronze_rows(*({"event_id": f"e{i}", "customer_id": f"C{i % 9}", "order_total": 1.5} for i in range(90))))
    lake.run_all()
    assert [lake.customer_ltv(c).collect() for c in ("C3", "nobody")] == [[("C3", 15.0)], [("nobody", 0.0)]]
    plan = lake.customer_ltv("C3")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*_bucket", plan) and "fact_orders" not in plan
    assert sum(1 for _ in tables.read(spark, lake.cfg.customer_ltv).select("customer_id").collect()) == 9


def test_broadcasts_are_measured_in_bytes(spark):
    from starmart.operators.joins import has_at_most, measured
    df = spark.createDataFrame([("x" * 1000, 1), (None, 2)], "s string, n int")
    rows, size = measured(df)
    assert rows == 2 and 1000 < size < 1200
    assert has_at_most(df, 2) and not has_at_most(df, 1) and not has_at_most(df, 2, 1000)
    assert measured(df.limit(0)) == (0, 0)
