"""Silver, customer state, fact and summary kept by increments."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from starmart.functions.schemas import BRONZE_SCHEMA
from starmart.operators.dims import dim_product
from starmart.operators.facts import fact_orders, fact_orders_sweep
from starmart.operators.scd2 import customer_latest, scd2_apply, scd2_changes, scd2_init
from starmart.plans import increments, marts
from starmart.plans.silver import build_silver
from starmart.session import local_path, scratch_dir
from starmart.sources import buckets


def feed(bronze_rows, seed, n, ids, day0):
    """Random versions of events; some invalid, without ids, or of other customers."""
    rng = random.Random(seed)
    return bronze_rows(*[{
        "event_id": rng.choice([f"e{rng.randrange(ids)}", f"e{rng.randrange(ids)}", None]), "customer_id": rng.choice([f"C{rng.randrange(8)}", None, "C1"]),
        "customer_name": rng.choice(["Ann", "Bob"]), "customer_region": rng.choice(["West", "East", None]), "product_id": f"P{rng.randrange(4)}",
        "product_category": rng.choice(["Desk", "Chair"]), "order_total": rng.choice([10.25, 3.5, 0.1, -1.0, None]),
        "status": rng.choice(["PAID", "SHIPPED", "CANCELLED", "TEST"]),
        "event_ts": rng.choice([dt.datetime(2026, 1, 1) + dt.timedelta(days=rng.randrange(40)), None]),
        "_ingested_at": dt.datetime(2026, 2, 1) + dt.timedelta(days=day0 + rng.randrange(9))} for _ in range(n)])


def rows(df):
    return sorted(map(str, df.collect()))


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{local_path(path)}/_bucket=*/*.parquet")}


def test_three_loads_equal_a_rebuild(spark, bronze_rows):
    silver, state, fact = (scratch_dir(spark, x) for x in ("s", "c", "f"))
    whole = dim = sales = None
    # load 3 brings older load times than load 2: late versions
    for load, (n, ids, day0) in enumerate([(60, 40, 0), (40, 60, 20), (30, 70, 10), (5, 5, 30)], 1):
        new = feed(bronze_rows, load, n, ids, day0)
        whole = new if whole is None else whole.unionByName(new)
        merged = increments.merge_silver(spark, silver, new, load, 8)
        want = build_silver(whole)
        assert rows(increments.silver(spark, silver).select(BRONZE_SCHEMA.names)) == rows(want.select(BRONZE_SCHEMA.names))
        increments.merge_customers(spark, state, merged, silver, 8)
        latest = increments.customers(spark, state)
        assert rows(latest) == rows(customer_latest(want).select(latest.columns))
        if dim is None:
            after = buckets.cut(scd2_init(latest), "dim")
            changed = after.select("customer_id")
        else:
            changed = buckets.cut(scd2_changes(latest, dim), "changes")
            after = buckets.cut(scd2_apply(dim, changed), "dim")
        change = increments.merge_fact(spark, fact, merged, after, changed, 8)
        sales = buckets.cut(increments.merge_summary(sales, change, dim, after), "sales")
        dim = after
        products = dim_product(want)
        plain = fact_orders(want, dim, products)
        kept = increments.fact(spark, fact)
        assert rows(kept.select("event_id", "customer_key")) == rows(plain.select("event_id", "customer_key"))
        assert rows(fact_orders_sweep(want, dim, products).select(plain.columns)) == rows(plain)
        assert rows(increments.summary(sales, products)) == rows(marts.sales_summary(plain, dim, products))


def test_untouched_buckets_are_neither_read_nor_written(spark, bronze_rows):
    path = scratch_dir(spark, "s")
    increments.merge_silver(spark, path, bronze_rows(*[{"event_id": f"e{i}"} for i in range(200)]), 1, 16)
    before = files(path)
    new = bronze_rows({"event_id": "e7", "_ingested_at": dt.datetime(2026, 5, 1)}, {"event_id": "e7", "order_total": 1.0})
    one = buckets.values_of(new.select(buckets.bucket_of(["event_id"], 16).alias("_bucket")))
    assert len(one) == 1
    other = [f for f in before if f"_bucket={one[0]}/" not in f]
    for f in other:  # a read of these would fail
        os.remove(os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc"))
        with open(f, "r+b") as o:
            o.write(b"spoiled!")
    spoiled = files(path)
    merged = increments.merge_silver(spark, path, new, 2, 16)
    assert merged.buckets == one and merged.added.count() == 1 and merged.removed.count() == 1
    after = files(path)
    assert {f: t for f, t in after.items() if f in other} == {f: t for f, t in spoiled.items() if f in other}
    assert set(after) - set(before) and not set(before) & {f for f in after if f"_bucket={one[0]}/" in f}


def test_a_replayed_load_writes_nothing(spark, bronze_rows):
    path = scratch_dir(spark, "s")
    first = bronze_rows(*[{"event_id": f"e{i % 30}", "quantity": i} for i in range(60)])
    increments.merge_silver(spark, path, first, 1, 8)
    before, held = files(path), rows(buckets.read(spark, path, increments.SILVER))
    again = increments.merge_silver(spark, path, first, 2, 8)
    assert again.buckets == [] and again.added.isEmpty() and again.removed.isEmpty()
    assert files(path) == before and rows(buckets.read(spark, path, increments.SILVER)) == held


def test_a_load_that_broke_off_is_completed(spark, bronze_rows, monkeypatch):
    path, whole = scratch_dir(spark, "s"), scratch_dir(spark, "w")
    load1, load2 = (feed(bronze_rows, s, 60, 40, d) for s, d in ((1, 0), (2, 5)))
    for target in (path, whole):
        increments.merge_silver(spark, target, load1, 1, 8)
    increments.merge_silver(spark, whole, load2, 2, 8)
    write = buckets.rewrite

    def broken(rows, path, touched, n):
        write(rows, path, touched[:3], n)
        raise OSError("lost the driver")

    monkeypatch.setattr(buckets, "rewrite", broken)
    with pytest.raises(OSError):
        increments.merge_silver(spark, path, load2, 2, 8)
    monkeypatch.setattr(buckets, "rewrite", write)
    increments.merge_silver(spark, path, load2, 2, 8)
    assert rows(buckets.read(spark, path, increments.SILVER)) == rows(buckets.read(spark, whole, increments.SILVER))


def test_an_emptied_bucket_is_removed(spark):
    path = scratch_dir(spark, "b")
    df = spark.createDataFrame([(i, i % 3) for i in range(9)], "x long, _bucket int")
    buckets.rewrite(df, path, [0, 1, 2], 9)
    buckets.rewrite(df.where("x = 100"), path, [1], 0)
    schema = df.select("x").schema
    assert sorted(r.x for r in buckets.read(spark, path, schema).collect()) == [0, 2, 3, 5, 6, 8]
    assert buckets.read(spark, scratch_dir(spark, "none"), schema).count() == 0


def test_a_bucket_of_many_rows_has_many_files(spark, monkeypatch):
    monkeypatch.setattr(buckets, "ROWS_PER_FILE", 100)
    path = scratch_dir(spark, "b")
    buckets.rewrite(spark.range(1000).select(F.col("id").alias("x"), F.lit(1).alias("_bucket")), path, [1], 1000)
    assert len(files(path)) > 5 and buckets.read(spark, path, spark.createDataFrame([], "x long").schema).count() == 1000
