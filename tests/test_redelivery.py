"""Deliveries told apart by state in the stream: restarts, late rows, expiry."""

import datetime as dt
import json

from starmart.functions.schemas import BRONZE_SCHEMA
from starmart.session import scratch_dir
from starmart.streaming.redelivery import start_redelivery_stream


def at(day, hour=0):
    return dt.datetime(2026, 1, 1, hour) + dt.timedelta(days=day)


def run(spark, src, out, ckpt):
    q = start_redelivery_stream(spark.readStream.schema(BRONZE_SCHEMA).parquet(src), out, ckpt, "10 days", available_now=True)
    q.awaitTermination()
    return [json.loads(p.json) for p in q.recentProgress]


def tags(spark, out):
    return sorted((r.event_id or "", r.quantity, r.delivery) for r in spark.read.parquet(out).collect())


def test_restarts_late_rows_and_expiry(spark, bronze_rows):
    src, out, ckpt = (scratch_dir(spark, x) for x in ("src", "out", "ckpt"))

    def drop(*rows):
        bronze_rows(*rows).write.mode("append").parquet(src)
        return run(spark, src, out, ckpt)

    drop({"event_id": "a", "event_ts": at(0), "quantity": 1}, {"event_id": "b", "event_ts": at(1), "quantity": 2},
         {"event_id": "b", "event_ts": at(1), "quantity": 3, "_ingested_at": at(99)}, {"event_id": None, "event_ts": at(2), "quantity": 4},
         {"event_id": "n", "event_ts": None, "quantity": 5})
    first = [("", 4, "accepted"), ("a", 1, "accepted"), ("b", 2, "duplicate"), ("b", 3, "accepted"), ("n", 5, "accepted")]
    assert tags(spark, out) == sorted(first)  # the newest of one batch counts
    run(spark, src, out, ckpt)
    assert tags(spark, out) == sorted(first)  # nothing new: nothing repeated

    drop({"event_id": "a", "event_ts": at(0), "quantity": 6}, {"event_id": None, "event_ts": at(2), "quantity": 7},
         {"event_id": "c", "event_ts": at(20), "quantity": 8})
    second = [*first, ("a", 6, "duplicate"), ("", 7, "duplicate"), ("c", 8, "accepted")]
    assert tags(spark, out) == sorted(second)

    # the watermark is day 10 now: older event times are late, whether their id was seen or not
    progress = drop({"event_id": "a", "event_ts": at(0), "quantity": 9}, {"event_id": "z", "event_ts": at(9, 23), "quantity": 10},
                    {"event_id": "d", "event_ts": at(10), "quantity": 11}, {"event_id": "c", "event_ts": at(20), "quantity": 12})
    third = [*second, ("a", 9, "late"), ("z", 10, "late"), ("d", 11, "accepted"), ("c", 12, "duplicate")]
    assert tags(spark, out) == sorted(third)
    # a, b, n and the NULL id have expired; c and d are held
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == 2
    assert spark.read.parquet(f"{out}/delivery=late").count() == 2


def test_rows_come_through_unchanged(spark, bronze_rows):
    src, out, ckpt = (scratch_dir(spark, x) for x in ("src", "out", "ckpt"))
    rows = bronze_rows({"event_ts": dt.datetime(2026, 1, 1, 1, 2, 3, 456789), "unit_price": 0.1 + 0.2, "customer_name": 'q"\\\nü', "quantity": None},
                       {"event_id": "e2", "order_total": None, "status": None, "_ingested_at": dt.datetime(2026, 1, 1, 0, 0, 0, 7)})
    rows.write.parquet(src)
    run(spark, src, out, ckpt)
    assert sorted(map(str, spark.read.parquet(out).drop("delivery").collect())) == sorted(map(str, rows.collect()))
