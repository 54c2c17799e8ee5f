"""Bloom filter before the shuffle; the day layout pruned through the calendar."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from starmart.operators import bloom
from starmart.operators.dims import dim_date
from starmart.plans import marts
from starmart.plans.silver import checked, incremental_checked
from starmart.session import scratch_dir


def test_members_pass_and_most_others_do_not(spark):
    ids = spark.range(5000).select((F.col("id") * 3).cast("string").alias("k")).unionByName(spark.createDataFrame([(None,)], "k string"))
    blocks = bloom.blocks_for(5001)
    rows = spark.range(15000).select(F.col("id").cast("string").alias("k")).unionByName(spark.createDataFrame([(None,)], "k string"))
    found = {r.k: r._maybe for r in bloom.tested(rows, "k", bloom.build(ids, "k", blocks), blocks).collect()}
    assert found[None] and all(found[str(i)] for i in range(0, 15000, 3))
    assert sum(found[str(i)] for i in range(15000) if i % 3) < 0.05 * 10000
    none = bloom.tested(rows, "k", bloom.build(ids.limit(0), "k", 1), 1)
    assert none.where("_maybe").count() == 0 and bloom.blocks_for(10 ** 12) == bloom.MAX_BLOCKS


def shuffled(df):
    """Bytes that the exchanges of an executed plan wrote."""
    df.write.format("noop").mode("overwrite").save()
    qe = df._jdf.queryExecution()
    df.collect()
    plan, total = [qe.executedPlan()], 0
    while plan:
        node = plan.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            plan.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            plan.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleBytesWritten").value()
        plan += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_a_large_id_set_shuffles_touched_rows_only(spark, bronze_rows):
    path = scratch_dir(spark, "prev")
    base = bronze_rows({"customer_name": "x" * 50})
    every = base.drop("event_id").crossJoin(spark.range(20000).select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("event_id")))
    checked(every.select(base.columns)).write.parquet(path)
    prev = spark.read.parquet(path)
    new = every.where("pmod(hash(event_id), 50) = 0").withColumn("_ingested_at", F.lit(dt.datetime(2027, 1, 1))).select(base.columns)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in before:
        spark.conf.set(k, "-1")
    try:
        by_filter = incremental_checked(prev, new, max_broadcast_keys=0)
        touched = new.select(F.col("event_id").alias("_tid")).distinct()
        match = F.col("event_id").eqNullSafe(F.col("_tid"))
        plain = prev.join(touched, match, "left_anti").unionByName(
            checked(prev.join(touched, match, "left_semi").drop("quality").unionByName(new)))
        rows = [sorted(map(str, df.select(prev.columns).collect())) for df in (by_filter, plain)]
        assert rows[0] == rows[1] and len(rows[0]) == 20000
        assert shuffled(by_filter) < 0.3 * shuffled(plain)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_only_the_days_of_the_year_are_read(spark):
    days = spark.range(0, 800, 10).select(F.date_add(F.lit(dt.date(2025, 1, 1)), F.col("id").cast("int")).alias("event_day"))
    fact = days.crossJoin(spark.createDataFrame([("PAID", 2.0), ("CANCELLED", 9.0)], "status string, order_total double"))
    path, cal = scratch_dir(spark, "by_day"), scratch_dir(spark, "cal")
    fact.write.partitionBy("status", "event_day").parquet(path)
    dim_date(days.select(F.col("event_day").cast("timestamp_ntz").alias("event_ts"))).write.partitionBy("year").parquet(cal)
    out = marts.revenue_by_week(spark.read.parquet(path), spark.read.parquet(cal), 2026)
    for f in glob.glob(f"{path.removeprefix('file:')}/status=*/event_day=2025-*/*.parquet"):  # never opened
        os.remove(os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc"))
        with open(f, "r+b") as o:
            o.write(b"spoiled!")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # the plan's text in full
    got = out.collect()
    assert sum(r.order_count for r in got) == days.where("year(event_day) = 2026").count()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "dynamicpruningexpression(event_day" in plan and "NOT status" in plan
    assert {r.revenue / r.order_count for r in got} == {2.0} and {r.year for r in got} == {2026}
