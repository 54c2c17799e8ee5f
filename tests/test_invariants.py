"""Invariants of the star schema on the driver tables, plus the skew-safe
sequence operator against a plain window (with a hot key)."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators.history import scd2_full_history
from starmart.operators.sequence import with_neighbor
from starmart.plans.catalog import StarBuild
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def build(spark):
    return StarBuild(spark, SF_SMALL)


def test_one_current_version_per_customer(build):
    for dim in (build.dim_customer, scd2_full_history(build.silver)):
        bad = dim.where("is_current").groupBy("customer_id").count().where("count > 1")
        assert bad.count() == 0


def test_no_overlapping_intervals(build):
    for dim in (build.dim_customer, scd2_full_history(build.silver)):
        a, b = dim.alias("a"), dim.alias("b")
        end_a = F.coalesce(F.col("a.end_date"), F.lit(dt.date(9999, 12, 31)))
        end_b = F.coalesce(F.col("b.end_date"), F.lit(dt.date(9999, 12, 31)))
        overlap = a.join(b, (F.col("a.customer_id") == F.col("b.customer_id"))
                         & (F.col("a.customer_key") != F.col("b.customer_key"))
                         & (F.col("a.start_date") < end_b) & (F.col("b.start_date") < end_a))
        assert overlap.count() == 0


def test_fact_unique_events_and_bounded(build):
    fact = build.fact
    assert fact.groupBy("event_id").count().where("count > 1").count() == 0
    assert fact.count() <= build.silver.count()


def test_counts_match_fixture(build):
    # FIXTURES.md §5, sf0.001
    assert build.silver.count() == 4513
    assert build.dim_customer.count() == 182
    assert build.fact.count() == 4469
    assert scd2_full_history(build.silver).count() == 185


def test_neighbor_matches_window_with_hot_key(spark):
    # one key holds a third of all rows; ties in ts resolved by id
    rows = [("hot", i // 3, i, f"v{i % 5}") for i in range(300)]
    rows += [(f"k{i % 40}", i % 7, 1000 + i, f"v{i % 3}") for i in range(600)]
    df = spark.createDataFrame(rows, "k string, ts int, id int, v string")
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = df.select("id", F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("n"))
    got_p = with_neighbor(df, "k", ["ts", "id"], ["v"], "prev", "_p", partitions=7)
    got_n = with_neighbor(df, "k", ["ts", "id"], ["v"], "next", "_n", partitions=7)
    got = (got_p.select("id", F.col("_p.v").alias("p"))
           .join(got_n.select("id", F.col("_n.v").alias("n")), "id"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # the hot key really is split over several segments
    segs = (df.repartitionByRange(7, "k", "ts", "id").withColumn("s", F.spark_partition_id())
            .where("k = 'hot'").select("s").distinct().count())
    assert segs > 1


def test_full_history_independent_of_partitioning(build):
    a = scd2_full_history(build.silver, partitions=3)
    b = scd2_full_history(build.silver, partitions=17)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
