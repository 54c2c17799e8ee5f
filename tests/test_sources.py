"""Bronze sources: malformed JSON, bad timestamps, NDJSON ingest, file stream
with checkpoint restart, Kafka record shape."""

import os

from starmart.session import local_path, scratch_dir
from starmart.sources import bronze as bronze_io
from starmart.sources import tables
from starmart.streaming.bronze_stream import file_source, start_bronze_stream


def _write(path, name, lines):
    os.makedirs(local_path(path), exist_ok=True)
    with open(os.path.join(local_path(path), name), "w") as f:
        f.write("\n".join(lines) + "\n")


GOOD = ('{"event_id":"e1","order_id":"O1","customer_id":"C1","customer_region":"West",'
        '"order_total":5.5,"status":"PAID","event_ts":"2026-01-01T10:00:00","quantity":2}')


def test_malformed_line_and_bad_timestamp(spark):
    raw = scratch_dir(spark, "raw_t")
    _write(raw, "a.json", [GOOD, "{broken", GOOD.replace("2026-01-01T10:00:00", "nope")
                            .replace('"e1"', '"e3"').replace('"quantity":2', '"quantity":3.7')])
    rows = bronze_io.typed_events(bronze_io.read_ndjson(spark, raw)).collect()
    by = {r.event_id: r for r in rows}
    assert len(rows) == 3 and None in by
    assert all(v is None for k, v in by[None].asDict().items() if k != "_ingested_at")
    assert by["e3"].event_ts is None and by["e3"].quantity is None
    assert by["e1"].event_ts.isoformat() == "2026-01-01T10:00:00"


def test_batch_ingest_appends_and_audits(spark):
    raw = scratch_dir(spark, "raw_t")
    _write(raw, "a.json", [GOOD])
    bronze = scratch_dir(spark, "bronze_t")
    bronze_io.ingest_batch(spark, raw, bronze)
    bronze_io.ingest_batch(spark, raw, bronze)   # rerun appends again
    df = spark.read.parquet(bronze)
    assert df.count() == 2 and "customer_region" in df.columns
    assert df.select("_source_file").first()[0].endswith("a.json")
    audit = tables.load_audit(spark, bronze).collect()
    assert [(a.version, a.rows) for a in audit] == [(1, 1), (0, 1)]


def test_stream_restart_adds_nothing(spark):
    raw = scratch_dir(spark, "raw_s")
    _write(raw, "a.json", [GOOD])
    _write(raw, "b.json", [GOOD.replace('"e1"', '"e2"'), "{broken"])
    out, ckpt = scratch_dir(spark, "bronze_s"), scratch_dir(spark, "ckpt_s")
    for _ in range(2):
        q = start_bronze_stream(file_source(spark, raw, 1), out, ckpt, available_now=True)
        q.awaitTermination()
    assert spark.read.parquet(out).count() == 3
    _write(raw, "c.json", [GOOD.replace('"e1"', '"e4"')])
    q = start_bronze_stream(file_source(spark, raw, 1), out, ckpt, available_now=True)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 4


def test_kafka_record_shape(spark):
    raw = scratch_dir(spark, "raw_k")
    _write(raw, "a.json", [GOOD])
    ev = bronze_io.typed_events(bronze_io.read_ndjson(spark, raw))
    rec = bronze_io.kafka_records(ev)
    assert [f.dataType.simpleString() for f in rec.schema.fields] == ["string", "binary", "binary"]
    back = bronze_io.decode_records(rec).collect()[0]
    assert back.key == "C1" and back.event_id == "e1" and back.order_total == 5.5


def test_publish_versions_and_read_newest(spark):
    path = scratch_dir(spark, "tbl")
    tables.publish(spark.range(3), path)
    tables.publish(spark.range(5), path)
    assert tables.versions(spark, path) == [0, 1]
    assert tables.read(spark, path).count() == 5
    assert tables.read(spark, path, version=0).count() == 3
    assert [r.rows for r in tables.load_audit(spark, path).collect()] == [5, 3]


def test_interval_trigger_bounded_run(spark):
    """Reference mode: processing-time trigger, bounded wait, then stop."""
    from starmart.streaming.bronze_stream import run_for
    raw = scratch_dir(spark, "raw_p")
    _write(raw, "a.json", [GOOD, GOOD.replace('"e1"', '"e2"')])
    out, ckpt = scratch_dir(spark, "bronze_p"), scratch_dir(spark, "ckpt_p")
    q = start_bronze_stream(file_source(spark, raw), out, ckpt, trigger_interval="1 second")
    q.processAllAvailable()
    run_for(q, 1)
    assert not q.isActive
    assert spark.read.parquet(out).count() == 2


def test_kafka_source_needs_connector(spark):
    import pytest
    from starmart.streaming.bronze_stream import kafka_available, kafka_source
    if kafka_available(spark):
        pytest.skip("connector present")
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        kafka_source(spark, "localhost:9092")


def test_silver_merge_stream_equals_batch_silver(spark, bronze_rows):
    """Versions of one event in different micro-batches; the newest (invalid)
    one arrives last and hides the event, as in batch silver."""
    import datetime as dt

    from starmart.plans import increments
    from starmart.plans.silver import build_silver
    from starmart.sources import buckets
    from starmart.streaming.silver_stream import start_silver_merge_stream
    D = dt.datetime
    batches = [
        [{"event_id": "e1", "_ingested_at": D(2026, 1, 1)}, {"event_id": "e2"},
         {"event_id": None, "order_id": "A", "_ingested_at": D(2026, 1, 1)}],
        [{"event_id": "e1", "quantity": 5, "_ingested_at": D(2026, 1, 3)},
         {"event_id": None, "order_id": "B", "_ingested_at": D(2026, 1, 3)}],
        [{"event_id": "e2", "order_total": -1.0, "_ingested_at": D(2026, 1, 5)},
         {"event_id": "e1", "quantity": 9, "_ingested_at": D(2025, 1, 1)}],
    ]
    src = scratch_dir(spark, "bronze_ms")
    for rows in batches:
        bronze_rows(*rows).coalesce(1).write.mode("append").parquet(src)
    schema = bronze_rows(*batches[0]).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    silver_path = scratch_dir(spark, "silver_ms")
    q = start_silver_merge_stream(stream, silver_path, scratch_dir(spark, "ckpt_ms"),
                                  available_now=True)
    q.awaitTermination()
    got = increments.silver(spark, silver_path)
    want = build_silver(bronze_rows(*[r for b in batches for r in b]))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert {(r.event_id, r.quantity, r.order_id) for r in got.collect()} == {("e1", 5, "O1"),
                                                                            (None, 1, "B")}
    loads = buckets.read(spark, silver_path, increments.SILVER).select("event_id", "_load").collect()
    assert {r.event_id: r._load for r in loads} == {"e1": 1, None: 1, "e2": 2}   # the batch that brought each winner


def test_a_micro_batch_that_failed_after_its_write_is_recognised(spark, bronze_rows, monkeypatch):
    """The write is done, the checkpoint has no record of it: the second start
    runs the batch again, adds no row and writes no file."""
    import glob
    import os

    import pytest

    from starmart.plans import increments
    from starmart.session import local_path
    from starmart.sources import buckets
    from starmart.streaming import silver_stream
    src, path, ckpt = (scratch_dir(spark, x) for x in ("src_replay", "silver_replay", "ckpt_replay"))
    stream = lambda: spark.readStream.schema(bronze_rows({}).schema).parquet(src)
    run = lambda: silver_stream.start_silver_merge_stream(stream(), path, ckpt, available_now=True, buckets=4).awaitTermination()
    bronze_rows(*({"event_id": f"e{i}"} for i in range(20))).write.mode("append").parquet(src)
    run()
    merge, merged = silver_stream.merge_silver, []

    def dies(*args):
        merged.append(merge(*args))
        raise OSError("lost before the checkpoint")

    bronze_rows({"event_id": "e3", "quantity": 9}, {"event_id": "new"}).write.mode("append").parquet(src)
    monkeypatch.setattr(silver_stream, "merge_silver", dies)
    with pytest.raises(Exception, match="lost before the checkpoint"):
        run()
    state = lambda: ({f: os.stat(f).st_mtime_ns for f in glob.glob(f"{local_path(path)}/_bucket=*/*.parquet")},
                     sorted(map(str, buckets.read(spark, path, increments.SILVER).collect())))
    held = state()
    assert len(held[1]) == 21 and merged[0].buckets
    monkeypatch.setattr(silver_stream, "merge_silver", lambda *args: merged.append(merge(*args)))
    run()
    assert len(merged) == 2 and merged[1].buckets == [] and state() == held
