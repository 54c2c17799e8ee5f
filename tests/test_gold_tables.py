"""Malformed lines kept apart; declared, bucketed gold tables."""

import pytest

from starmart.functions.schemas import DIM_CUSTOMER_SCHEMA, FACT_ORDERS_SCHEMA, ContractError
from starmart.session import scratch_dir
from starmart.sources import bronze as bronze_io
from starmart.sources import catalog_tables as gold


def test_good_and_corrupt_lines_are_all_lines(spark, tmp_path):
    lines = ['{"event_id":"a","quantity":1,"event_ts":"2026-01-01T10:00:00"}', '{"event_id":"b","quantity":"x"}', '{"event_id":"c"', "no json", "",
             "   ", "[1]", "7", '{"event_id":"d","event_ts":"nope"}', '{"other":1}', "{}", '{"event_id":"e","order_total":1.5} ', "null"]
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "one.json").write_text("\n".join(lines))
    good, corrupt = bronze_io.split_lines(bronze_io.read_lines(spark, str(tmp_path / "raw")))
    bad = {r.raw: r.reason for r in corrupt.collect()}
    assert good.count() + len(bad) == sum(bool(x.strip()) for x in lines)
    assert bad == {'{"event_id":"b","quantity":"x"}': "bad_field", '{"event_id":"c"': "not_json", "no json": "not_json", "[1]": "not_json",
                   "7": "not_json", "null": "not_json"}
    assert sorted(str(r.event_id) for r in good.collect()) == ["None", "None", "a", "d", "e"]
    bronze_path, side = scratch_dir(spark, "b"), scratch_dir(spark, "side")
    rec = bronze_io.ingest_batch(spark, str(tmp_path / "raw"), bronze_path, side)
    assert (rec["rows"], rec["corrupt"]) == (5, 6)
    kept = spark.read.parquet(side).first()
    assert kept.file.endswith("one.json") and kept._ingested_at is not None
    assert {r._source_file.rsplit("/", 1)[1] for r in spark.read.parquet(bronze_path).collect()} == {"one.json"}


def tables(spark, n=16):
    fact = gold.create(spark, "fact_orders", FACT_ORDERS_SCHEMA, scratch_dir(spark, "gf"), "customer_key", n, {"layer": "gold", "retention": "all"}, "orders")
    dim = gold.create(spark, "dim_customer", DIM_CUSTOMER_SCHEMA, scratch_dir(spark, "gd"), "customer_key", n)
    return fact, dim


def test_the_fact_is_not_shuffled_by_its_bucket_key(spark):
    fact, dim = tables(spark)
    orders = spark.range(2000).selectExpr("string(id) order_id", "string(id) event_id", "string(id % 40) customer_key", "'p' product_key", "20260101 date_key",
                                          "1 quantity", "1.0D unit_price", "double(id % 7) order_total", "'PAID' status", "timestamp_ntz'2026-01-01' event_ts")
    customers = spark.range(40).selectExpr("string(id) customer_key", "string(id) customer_id", "'n' customer_name", "concat('r', id % 3) customer_region",
                                           "date'2026-01-01' start_date", "cast(null as date) end_date", "id % 4 > 0 is_current")
    gold.load(orders, fact, "customer_key")
    gold.load(customers, dim, "customer_key")
    out = gold.revenue_by_region(spark, fact, dim)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # one exchange, of the regions' totals; none below the join
    assert plan.count("Exchange") == 1 and plan.index("Exchange hashpartitioning(customer_region") < plan.index("SortMergeJoin")
    assert plan.count("SelectedBucketsCount: 16 out of 16") == 2
    want = {f"r{k}": (float(sum(i % 7 for i in range(2000) if i % 40 % 3 == k and i % 40 % 4)), sum(i % 40 % 3 == k and i % 40 % 4 > 0 for i in range(2000)))
            for k in range(3)}
    assert {r.customer_region: (r.revenue, r.order_count) for r in out.collect()} == want
    props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {fact}").collect()}
    assert props["layer"] == "gold" and props["retention"] == "all"
    gold.load(orders.limit(0), fact, "customer_key")  # a load replaces
    assert spark.table(fact).count() == 0


def test_wrong_types_and_names_are_refused_at_write(spark):
    fact, dim = tables(spark, 2)
    rows = spark.range(1).selectExpr(
        "'k' customer_key", "'c' customer_id", "'n' customer_name", "'r' customer_region", "1.5D start_date", "cast(null as date) end_date", "true is_current")
    with pytest.raises(Exception, match="start_date"):
        gold.load(rows, dim, "customer_key")
    with pytest.raises(ContractError, match="columns of"):
        gold.load(rows.drop("end_date"), dim, "customer_key")
    assert spark.table(dim).count() == 0
