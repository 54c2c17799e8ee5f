"""Hand-made cases for each semantic rule of the build (FIXTURES.md §6)."""

import datetime as dt

from pyspark.sql import functions as F

from starmart.operators.dims import dim_date, dim_product
from starmart.operators.facts import fact_orders
from starmart.operators.quality import quality_gate
from starmart.operators.scd2 import (customer_latest, dim_as_of, scd2_apply, scd2_changes,
                                     scd2_init, scd2_merge_upsert)
from starmart.plans import marts
from starmart.plans.silver import build_silver, silver_split

D = dt.datetime


def test_newest_version_invalid_drops_event(bronze_rows):
    b = bronze_rows({"event_id": "e1", "_ingested_at": D(2026, 1, 1)},
                    {"event_id": "e1", "order_total": -1.0, "_ingested_at": D(2026, 1, 2)})
    assert build_silver(b).count() == 0


def test_null_event_ids_keep_one(bronze_rows):
    b = bronze_rows({"event_id": None, "_ingested_at": D(2026, 1, 1)},
                    {"event_id": None, "_ingested_at": D(2026, 1, 2), "order_id": "O2"})
    rows = build_silver(b).collect()
    assert len(rows) == 1 and rows[0].order_id == "O2"


def test_null_total_and_status_dropped_with_reason(bronze_rows):
    b = bronze_rows({"event_id": "e1", "order_total": None},
                    {"event_id": "e2", "status": None},
                    {"event_id": "e3", "status": "TEST", "order_total": 0.0})
    silver, rejected = silver_split(b)
    assert silver.count() == 0
    reasons = {r.event_id: r.reject_reason for r in rejected.collect()}
    assert reasons == {"e1": "bad_total", "e2": "bad_status", "e3": "bad_total"}


def test_tie_break_is_deterministic(bronze_rows):
    same = {"event_id": "e1", "_ingested_at": D(2026, 1, 2)}
    b = bronze_rows(dict(same, quantity=1), dict(same, quantity=3), dict(same, quantity=2))
    assert [r.quantity for r in build_silver(b).collect()] == [3]


def _two_loads(bronze_rows, load1, load2, **kw):
    s1 = build_silver(bronze_rows(*load1))
    s2 = build_silver(bronze_rows(*(load1 + load2)))
    dim = scd2_init(customer_latest(s1))
    latest = customer_latest(s2)
    changes = scd2_changes(latest, dim, null_safe=kw.get("null_safe", False))
    return s2, dim, changes, scd2_apply(dim, changes, latest, insert_new=kw.get("insert_new", False))


def test_same_day_change_makes_zero_length_version(bronze_rows):
    day = D(2026, 3, 1, 9)
    load1 = [{"event_id": "a", "event_ts": day}]
    load2 = [{"event_id": "b", "event_ts": day.replace(hour=12), "customer_region": "East"}]
    silver, _, changes, dim = _two_loads(bronze_rows, load1, load2)
    assert changes.count() == 1
    closed = dim.where(~F.col("is_current")).collect()
    assert len(closed) == 1 and closed[0].start_date == closed[0].end_date
    fact = fact_orders(silver, dim, dim_product(silver))
    keys = {r.customer_key for r in fact.collect()}
    assert closed[0].customer_key not in keys and fact.count() == 2


def test_null_to_value_change_only_null_safe(bronze_rows):
    load1 = [{"event_id": "a", "customer_region": None, "event_ts": D(2026, 1, 1)}]
    load2 = [{"event_id": "b", "customer_region": "East", "event_ts": D(2026, 2, 1)}]
    assert _two_loads(bronze_rows, load1, load2)[2].count() == 0
    assert _two_loads(bronze_rows, load1, load2, null_safe=True)[2].count() == 1


def test_rerun_without_changes_is_noop(bronze_rows):
    load1 = [{"event_id": "a"}, {"event_id": "b", "customer_id": "C2"}]
    _, dim, changes, after = _two_loads(bronze_rows, load1, [])
    assert changes.count() == 0
    assert sorted(map(tuple, after.collect())) == sorted(map(tuple, dim.collect()))


def test_new_customer_on_second_load(bronze_rows):
    load1 = [{"event_id": "a"}]
    load2 = [{"event_id": "b", "customer_id": "C9", "event_ts": D(2026, 2, 1)}]
    ref = _two_loads(bronze_rows, load1, load2)[3]
    assert {r.customer_id for r in ref.collect()} == {"C1"}
    with_new = _two_loads(bronze_rows, load1, load2, insert_new=True)[3]
    assert {r.customer_id for r in with_new.collect()} == {"C1", "C9"}


def test_region_change_closes_and_inserts(bronze_rows):
    load1 = [{"event_id": "a", "event_ts": D(2026, 1, 1)}]
    load2 = [{"event_id": "b", "event_ts": D(2026, 2, 1), "customer_region": "East"}]
    silver, _, _, dim = _two_loads(bronze_rows, load1, load2)
    rows = sorted(dim.collect(), key=lambda r: r.start_date)
    assert [(r.customer_region, r.is_current) for r in rows] == [("West", False), ("East", True)]
    assert rows[0].end_date == rows[1].start_date == dt.date(2026, 2, 1)
    fact = fact_orders(silver, dim, dim_product(silver))
    by_event = {r.event_id: r.customer_key for r in fact.collect()}
    assert by_event == {"a": rows[0].customer_key, "b": rows[1].customer_key}
    # current-version-only revenue excludes the order of the closed version
    top = marts.revenue_top10(fact, dim, dim_product(silver)).collect()
    assert [(r.customer_region, r.orders) for r in top] == [("East", 1)]
    as_was = marts.revenue_as_was(fact, dim, dim_product(silver)).collect()
    assert sorted((r.customer_region, r.order_count) for r in as_was) == [("East", 1), ("West", 1)]
    assert dim_as_of(dim, dt.date(2026, 1, 15)).collect()[0].customer_region == "West"


def test_merge_upsert_closes_on_region_and_inserts_new(bronze_rows):
    load1 = [{"event_id": "a"}, {"event_id": "b", "customer_id": "C2"}]
    load2 = [{"event_id": "c", "customer_region": "East", "event_ts": D(2026, 2, 1)},
             {"event_id": "d", "customer_id": "C2", "customer_name": "Bob",
              "event_ts": D(2026, 2, 1)},
             {"event_id": "e", "customer_id": "C3", "event_ts": D(2026, 2, 1)}]
    s1 = build_silver(bronze_rows(*load1))
    s2 = build_silver(bronze_rows(*(load1 + load2)))
    out = {r.customer_id: r for r in
           scd2_merge_upsert(scd2_init(customer_latest(s1)), customer_latest(s2)).collect()}
    assert out["C1"].is_current is False and out["C1"].end_date == dt.date(2026, 2, 1)
    assert out["C2"].is_current is True  # name change alone does not match the condition
    assert out["C3"].is_current is True and out["C3"].start_date == dt.date(2026, 2, 1)


def test_product_drift_latest_wins_no_fanout(bronze_rows):
    b = bronze_rows({"event_id": "a", "product_category": "Old", "event_ts": D(2026, 1, 1)},
                    {"event_id": "b", "product_category": "New", "event_ts": D(2026, 1, 2)})
    silver = build_silver(b)
    dp = dim_product(silver).collect()
    assert len(dp) == 1 and dp[0].product_category == "New"
    dim = scd2_init(customer_latest(silver))
    assert fact_orders(silver, dim, dim_product(silver)).count() == 2


def test_gate_boundary_is_strict(bronze_rows):
    rows = [{"event_id": f"e{i}"} for i in range(96)]
    rows += [{"event_id": "n1", "order_id": None}, {"event_id": "n2", "customer_id": None},
             {"event_id": "b1", "order_total": 0.0}, {"event_id": "b2", "order_total": -5.0}]
    g = quality_gate(bronze_rows(*rows), (0.02, 0.01)).collect()
    assert [(r.threshold, r.nulls, r.bad_totals, r.decision) for r in g] == [
        (0.02, 2, 2, "proceed"), (0.01, 2, 2, "quarantine")]


def test_empty_bronze(bronze_rows):
    empty = bronze_rows({"event_id": "x"}).limit(0)
    g = quality_gate(empty).collect()[0]
    assert (g.total, g.null_rate, g.decision) == (0, 1.0, "quarantine")
    assert dim_date(build_silver(empty)).count() == 0


def test_dim_date_calendar(bronze_rows):
    b = bronze_rows({"event_id": "a", "event_ts": D(2026, 12, 31)},
                    {"event_id": "b", "event_ts": D(2027, 1, 3)})
    rows = dim_date(build_silver(b)).orderBy("full_date").collect()
    assert [r.date_key for r in rows] == [20261231, 20270101, 20270102, 20270103]
    first = rows[1]
    assert (first.year, first.week_of_year, first.day_of_week, first.is_weekend) == (
        2027, 53, "Friday", False)
    assert rows[2].is_weekend and rows[3].is_weekend


def test_customer_ltv_unknown_is_zero(spark, bronze_rows):
    silver = build_silver(bronze_rows({"event_id": "a"}))
    dim = scd2_init(customer_latest(silver))
    fact = fact_orders(silver, dim, dim_product(silver))
    assert marts.customer_ltv(fact, dim, "NOPE").collect()[0].ltv == 0.0
    assert marts.customer_ltv(fact, dim, "C1").collect()[0].ltv == 10.0


def test_merge_into_generic(spark):
    from starmart.operators.scd2 import merge_into
    target = spark.createDataFrame(
        [("k1", 1, True), ("k2", 2, True), ("k3", 3, False), (None, 4, True)],
        "k string, v int, live boolean")
    source = spark.createDataFrame([("k1", 10), ("k2", 1), ("k3", 30), ("k9", 90), (None, 99)],
                                   "k string, v int")
    out = merge_into(target, source, "k",
                     target_filter=F.col("t_live"),
                     matched_condition=F.col("s_v") > F.col("t_v"),
                     matched_set={"v": F.col("s_v")},
                     not_matched_insert={"k": F.col("s_k"), "v": F.col("s_v"),
                                         "live": F.lit(True)})
    got = sorted(map(tuple, out.collect()), key=str)
    # k1 updated (10 > 1); k2 kept (1 < 2); k3 not live -> passes through and,
    # as the ON clause only sees live rows, k3 of the source is inserted;
    # k9 inserted; NULL keys never match: target NULL kept, source NULL inserted
    assert got == sorted([("k1", 10, True), ("k2", 2, True), ("k3", 3, False),
                          ("k3", 30, True), ("k9", 90, True), (None, 4, True),
                          (None, 99, True)], key=str)
