"""Steps whose work must follow the input: no large broadcasts, no second shuffles, no rewrites per batch."""

import datetime as dt
import glob

from pyspark.sql import functions as F

from starmart.functions.schemas import BRONZE_SCHEMA
from starmart.operators import intervals
from starmart.operators.joins import bounded_broadcast
from starmart.plans import increments
from starmart.plans.catalog import FIRST_LOAD_BEFORE, StarBuild
from starmart.plans.silver import build_silver, silver_split
from starmart.session import local_path, scratch_dir
from starmart.sources import bronze, buckets
from starmart.streaming import redelivery, silver_stream
from starmart.streaming.bronze_stream import file_source, start_bronze_stream
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_merge_finds_replaced_rows_without_a_join(spark, bronze_rows, monkeypatch):
    path = scratch_dir(spark, "s")
    first = bronze_rows(*({"event_id": f"e{i}"} for i in range(20)), {"event_id": None})
    second = bronze_rows(*({"event_id": f"e{i}", "quantity": 2, "order_total": -1.0 if i == 7 else 1.0} for i in range(5, 9)))
    monkeypatch.setattr(type(first), "join", None)
    increments.merge_silver(spark, path, first, 1, 4)
    merged = increments.merge_silver(spark, path, second, 2, 4)
    assert sorted(r.event_id for r in merged.added.collect()) == ["e5", "e6", "e8"]
    assert sorted((r.event_id, r.quantity) for r in merged.removed.collect()) == [(f"e{i}", 1) for i in range(5, 9)]
    assert rows(increments.silver(spark, path)) == rows(build_silver(first.unionByName(second)))


def test_what_is_measured_too_large_is_not_broadcast_by_estimate(spark):
    ids = spark.createDataFrame([("a",), ("b",)], "k string")
    joined = ids.join(bounded_broadcast(ids.withColumn("x", F.lit(1)), 1), "k")
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 2


def test_ids_share_state_cells(spark, bronze_rows, monkeypatch):
    monkeypatch.setattr(redelivery, "CELLS", 3)
    src, out, ckpt = (scratch_dir(spark, x) for x in ("src", "out", "ckpt"))
    for q in (1, 2):
        bronze_rows(*({"event_id": f"e{i}" if i else None, "quantity": q} for i in range(40))).write.mode("append").parquet(src)
        stream = redelivery.start_redelivery_stream(spark.readStream.schema(BRONZE_SCHEMA).parquet(src), out, ckpt, "10 days", available_now=True)
        stream.awaitTermination()
        assert stream.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3
    tags = {(r.event_id, r.quantity): r.delivery for r in spark.read.parquet(out).collect()}
    assert tags == {(f"e{i}" if i else None, q): {1: "accepted", 2: "duplicate"}[q] for i in range(40) for q in (1, 2)}


def test_batches_beside_a_large_silver_are_merged_together(spark, bronze_rows, monkeypatch):
    monkeypatch.setattr(silver_stream, "MERGE_AT_ONCE", 0)
    merge, merges = silver_stream.merge_silver, []
    monkeypatch.setattr(silver_stream, "merge_silver", lambda *args: merges.append(merge(*args)))
    src, path, ckpt = (scratch_dir(spark, x) for x in ("src", "s", "ckpt"))
    feed = [bronze_rows(*({"event_id": f"e{(k * 3 + i) % 14}", "quantity": k, "_ingested_at": dt.datetime(2026, 1, 1 + (k * 5) % 7)}
                          for i in range(6))) for k in range(6)]
    whole = feed[0]
    for k, df in enumerate(feed):
        df.coalesce(1).write.mode("append").parquet(src)
        whole = whole.unionByName(df) if k else df
        stream = spark.readStream.schema(BRONZE_SCHEMA).parquet(src)
        silver_stream.start_silver_merge_stream(stream, path, ckpt, available_now=True, buckets=4).awaitTermination()
        assert rows(increments.silver(spark, path)) == rows(build_silver(whole).select(BRONZE_SCHEMA.names))
    assert len(merges) == 2  # the first batch, and four batches' rows of it


def test_keys_of_few_events_are_swept_without_a_cut(spark, monkeypatch):
    monkeypatch.setattr(intervals, "cut", None)
    day = F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") / 300).cast("int"))
    key = F.concat(F.lit("k"), F.col("id") % 300)
    events = spark.range(1500).select("id", key.alias("k"), day.alias("at"))
    versions = spark.range(900).select(key.alias("k"), day.alias("s"), F.date_add(day, 1).alias("e"), F.col("id").alias("v"))
    got = {r.id: r.v for r in intervals.as_of(events, versions, "k", "at", "s", "e", ["v"]).collect()}
    assert got == {i: i for i in range(900)}


def test_a_drop_is_compressed_and_parsed_by_many_tasks(spark, bronze_rows):
    raw, out, plain = (scratch_dir(spark, x) for x in ("raw", "out", "plain"))
    events = bronze_rows(*({"event_id": f"e{i}"} for i in range(50)))
    bronze.write_ndjson(events, raw, **bronze.DROP)
    assert glob.glob(f"{local_path(raw)}/*.gz") and not glob.glob(f"{local_path(raw)}/*.txt")
    spark.createDataFrame([("",), ("no json",), ('{"event_id":"w","quantity":"many"}',)], "value string").write.mode("append").text(raw)
    for folder, parsers in ((out, 3), (plain, None)):
        start_bronze_stream(file_source(spark, raw, 2, parsers), folder, scratch_dir(spark, "ckpt"), available_now=True).awaitTermination()
    read = [spark.read.parquet(x).drop("_ingested_at") for x in (out, plain)]
    assert rows(read[0].select(read[1].columns)) == rows(read[1]) and read[0].count() == 52


def test_both_loads_are_deduplicated_in_the_partitions_of_the_order_join(spark):
    b = StarBuild(spark, SF_SMALL, materialize=False)
    plan = b.winners._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(event_id") == plan.count("Exchange hashpartitioning(_order") == 0
    first = F.col("event_ts") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz")
    assert rows(b.silver_shared) == rows(silver_split(b.bronze)[0].select(b.silver_shared.columns))
    assert rows(b.silver_load1) == rows(silver_split(b.bronze.where(first))[0].select(b.silver_load1.columns))


def test_a_bucket_is_written_as_it_lies(spark):
    path = scratch_dir(spark, "b")
    df = buckets.cut(spark.range(90).select(F.col("id").alias("x"), (F.col("id") % 3).cast("int").alias("_bucket")), "lies", ["_bucket"])
    buckets.rewrite(df, path, [0, 2], None)
    assert sorted(r.x for r in buckets.read(spark, path, df.select("x").schema).collect()) == [i for i in range(90) if i % 3 != 1]
