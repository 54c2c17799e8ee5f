"""Steps of the star queries whose work must follow the input: customers of both loads from one shuffle, product
keys without a join, marts without a second join of the customer dimension, narrow rows in the layout by day."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart import session
from starmart.operators.facts import fact_orders
from starmart.operators.scd2 import customer_latest, customer_latest_of, latest_of
from starmart.plans import catalog, marts
from starmart.plans.catalog import StarBuild
from starmart.plans.silver import silver_split
from starmart.sources import tables
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(map(str, df.collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    b = StarBuild(spark, SF_SMALL)
    return b, b.fact.localCheckpoint()


def test_customers_of_both_loads_come_out_of_one_shuffle(spark):
    data = [(c, f"e{i}", dt.datetime(2020, 1, 1 + (i * 7) % 20), f"n{i}" if i % 3 else None, "R", i % 4 == 0, i % 5 < 3)
            for i, c in enumerate(["a", "b", None, "c", "a", "d"] * 6)] + [("late", "x", None, "n", "R", False, True), ("none", "y", None, "n", "R", False, False)]
    df = spark.createDataFrame(data, "customer_id string, event_id string, event_ts timestamp_ntz, customer_name string, "
                               "customer_region string, one boolean, two boolean")
    state = customer_latest_of(df, {"_one": F.col("one"), "_two": F.col("two")})
    assert plan_of(state).count("Exchange hashpartitioning(customer_id") == 1
    for name in ("one", "two"):
        got, want = latest_of(state, f"_{name}"), customer_latest(df.where(name))
        assert got.columns == want.columns and got.count() and rows(got) == rows(want)


def test_both_loads_share_the_state_in_the_star(spark, star):
    b, _ = star
    first = F.col("event_ts") < F.lit(catalog.FIRST_LOAD_BEFORE).cast("timestamp_ntz")
    assert rows(b.latest) == rows(customer_latest(silver_split(b.bronze)[0]))
    assert rows(b.latest_load1) == rows(customer_latest(silver_split(b.bronze.where(first))[0]))


def test_product_keys_of_the_own_silver_need_no_join(spark, star):
    b = StarBuild(spark, SF_SMALL)
    got = b.fact
    assert "dim_product" not in b.__dict__
    assert rows(got) == rows(fact_orders(b.silver_shared, b.dim_customer, b.dim_product))


def test_marts_over_a_fact_with_versions_join_customers_once(star, monkeypatch):
    b, fact = star
    for bound in (marts.MAX_BROADCAST_DIM_ROWS, 0):
        monkeypatch.setattr(marts, "MAX_BROADCAST_DIM_ROWS", bound)
        for mart, more in ((marts.revenue_as_was, ()), (marts.revenue_top10, ()), (marts.sales_summary, ()),
                           (marts.revenue_top10_sql, ()), (marts.sales_summary_by_region, (catalog.REGION,))):
            got, want = mart(b.fact_versions, None, b.dim_product, *more), mart(fact, b.dim_customer, b.dim_product, *more)
            assert "hashpartitioning(customer_key" not in plan_of(got)
            assert got.schema.simpleString() == want.schema.simpleString()
            assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_the_layout_by_day_deals_rows_without_product_keys(spark, monkeypatch):
    publish, laid = tables.publish, []
    monkeypatch.setattr(catalog.tables, "publish", lambda df, *args, **kw: laid.append(df) or publish(df, *args, **kw))
    catalog.q_fact_by_day(StarBuild(spark, SF_SMALL))
    dealt = laid[0]._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")
    assert "md5(" in dealt[0] and "md5(" not in dealt[1]


def test_fact_and_customers_carry_no_product_names(spark, tmp_path):
    # parts that share a key tie until name, category and price decide
    for t in ("customer", "orders", "lineitem", "nation", "region"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    price = F.col("p_retailprice")
    twice = (part.unionByName(part.where("p_partkey % 3 = 0").withColumns({"p_name": F.lit(None).cast("string"), "p_retailprice": price + 1}))
             .unionByName(part.where("p_partkey % 4 = 0").withColumns({"p_name": F.lit("zz"), "p_retailprice": price + 2}))
             .unionByName(part.where("p_partkey % 5 = 0").withColumns({"p_type": F.lit(None).cast("string"), "p_retailprice": price + 3}))
             .unionByName(part.where("p_partkey % 7 = 0").withColumn("p_retailprice", F.lit(None).cast("double"))))
    twice.write.parquet(f"{tmp_path}/part.parquet")
    named, lean = StarBuild(spark, str(tmp_path)), StarBuild(spark, str(tmp_path), named_products=False)
    assert not {"product_name", "product_category"} & set(lean.winners.columns)
    assert lean.fact.columns == named.fact.columns and rows(lean.fact) == rows(named.fact)
    assert rows(lean.dim_customer) == rows(named.dim_customer) and rows(lean.latest_load1) == rows(named.latest_load1)


@pytest.mark.parametrize("name", ["fact_orders", "fact_by_status", "fact_by_day", "customer_ltv_all"])
def test_fact_queries_are_built_without_product_names(spark, monkeypatch, name):
    asked = []
    events = catalog.order_events
    monkeypatch.setattr(catalog, "order_events", lambda *args, **kw: asked.append(kw["named_products"]) or events(*args, **kw))
    catalog.registered()[name](spark, SF_SMALL)
    assert asked == [False]


def test_large_shuffles_are_read_in_parts_that_sort_in_memory():
    # 128 MB compressed unpack to several times as much, more than a task of a 2-core executor of 1.8 GB heap sorts
    assert session.DEFAULT_CONF["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "32MB"
