"""Two loads through the stage runner give the registered queries' results."""

import datetime as dt

from pyspark.sql import functions as F

from starmart.plans.catalog import StarBuild
from starmart.plans.runner import Lake, LakeConfig
from starmart.session import scratch_dir
from starmart.sources.fixtures import order_events
from tests.conftest import SF_SMALL


def test_two_loads_equal_queries(spark):
    lake = Lake(spark, LakeConfig(scratch_dir(spark, "lake_t")))
    ev = order_events(spark, SF_SMALL)
    first = F.col("event_ts") < F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz")
    lake.append_bronze(ev.where(first))
    assert lake.run_all() is not None
    lake.append_bronze(ev.where(~first))
    top = lake.run_all()
    b = StarBuild(spark, SF_SMALL)
    from starmart.plans import marts
    want = marts.revenue_top10(b.fact, b.dim_customer, b.dim_product).collect()
    assert top.collect() == want
    dim = lake.table(lake.cfg.dim_customer)
    assert sorted(map(tuple, dim.collect())) == sorted(map(tuple, b.dim_customer.collect()))
    assert lake.table(lake.cfg.fact_orders).count() == b.fact.count()
    assert lake.quarantine().count() == b.rejected.count()
    stages = [e["stage"] for e in lake.log]
    assert stages.count("fact") == 2 and stages.count("gate") == 2


def test_gate_quarantine_stops_load(spark):
    lake = Lake(spark, LakeConfig(scratch_dir(spark, "lake_q")))
    lake.append_bronze(order_events(spark, SF_SMALL))
    assert lake.run_all(threshold=0.005) is None
    assert [e["stage"] for e in lake.log] == ["ingest", "gate"]


def test_cli_ingest_then_all(spark, capsys):
    from starmart.plans.runner import main
    from starmart.sources import bronze as bronze_io
    root = scratch_dir(spark, "lake_cli")
    cfg = LakeConfig(root)
    bronze_io.write_ndjson(order_events(spark, SF_SMALL), cfg.raw, files=3)
    assert main(["--lake", root, "--stage", "ingest"]) == 0
    assert main(["--lake", root, "--stage", "all"]) == 0
    out = capsys.readouterr().out
    assert "AMERICA" in out and "'stage': 'fact'" in out
    lake = Lake(spark, cfg)
    lake.register_views()
    n = spark.sql("SELECT count(*) AS n FROM fact_orders f JOIN dim_date d "
                  "ON f.date_key = d.date_key").first().n
    # one load: no customer is first seen after the first load, so nobody is
    # missed; every fact row finds its calendar day
    assert n == lake.table(cfg.fact_orders).count() > 0
    assert lake.table(cfg.dim_date).select("year").distinct().count() == 7


def _run_two_loads(spark, first_rows, second_rows, incremental):
    lake = Lake(spark, LakeConfig(scratch_dir(spark, "lake_i")))
    lake.append_bronze(first_rows)
    lake.build_silver(incremental=incremental)
    lake.append_bronze(second_rows)
    lake.build_silver(incremental=incremental)
    return lake


def test_incremental_silver_equals_full_rebuild(spark):
    from starmart.sources import tables
    ev = order_events(spark, SF_SMALL)
    first = F.col("event_ts") < F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz")
    a = _run_two_loads(spark, ev.where(first), ev.where(~first), True)
    b = _run_two_loads(spark, ev.where(first), ev.where(~first), False)

    def rows(lake):
        return sorted(map(tuple, tables.read(spark, lake.cfg.silver).collect()))
    assert rows(a) == rows(b)
    assert tables.load_audit(spark, a.cfg.silver, 1).first().operation == "MERGE"
    assert tables.load_audit(spark, b.cfg.silver, 1).first().operation == "WRITE"


def test_incremental_newest_invalid_and_null_ids(spark, bronze_rows):
    D = dt.datetime
    load1 = bronze_rows({"event_id": "e1", "_ingested_at": D(2026, 1, 1)},
                        {"event_id": None, "order_id": "A", "_ingested_at": D(2026, 1, 1)},
                        {"event_id": "e2", "_ingested_at": D(2026, 1, 1)})
    load2 = bronze_rows({"event_id": "e1", "order_total": -1.0, "_ingested_at": D(2026, 1, 2)},
                        {"event_id": None, "order_id": "B", "_ingested_at": D(2026, 1, 2)},
                        {"event_id": "e2", "_ingested_at": D(2025, 1, 1), "quantity": 9})
    for inc in (True, False):
        lake = _run_two_loads(spark, load1, load2, inc)
        silver = {(r.event_id, r.order_id, r.quantity) for r in lake.silver().collect()}
        assert silver == {(None, "B", 1), ("e2", "O1", 1)}, inc
        assert [r.event_id for r in lake.quarantine().collect()] == ["e1"]


def test_batch_and_stream_bronze_both_visible(spark):
    """A stream and batch loads feed one lake; silver sees both."""
    from starmart.sources import bronze as bronze_io
    cfg = LakeConfig(scratch_dir(spark, "lake_mix"))
    lake = Lake(spark, cfg)
    ev = order_events(spark, SF_SMALL)
    first = F.col("event_ts") < F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz")
    bronze_io.write_ndjson(ev.where(first), cfg.raw)
    lake.stream(available_now=True)                     # stream folder
    late = scratch_dir(spark, "raw_late2")
    bronze_io.write_ndjson(ev.where(~first), late)
    lake.ingest(late)                                   # batch folder
    assert lake.bronze().count() == ev.count()
    assert lake.bronze().where("_source_file IS NULL").count() == ev.where(first).count()
    lake.build_silver()
    assert lake.silver().count() > 0


def test_gate_on_increment_only(spark, bronze_rows):
    lake = Lake(spark, LakeConfig(scratch_dir(spark, "lake_g")))
    lake.append_bronze(bronze_rows(*[{"event_id": f"a{i}", "order_id": None} for i in range(10)]))
    lake.build_silver()
    lake.append_bronze(bronze_rows(*[{"event_id": f"b{i}"} for i in range(10)]))
    whole = lake.gate()
    inc = lake.gate(increment_only=True)
    assert (whole["total"], whole["nulls"], whole["decision"]) == (20, 10, "quarantine")
    assert (inc["total"], inc["nulls"], inc["decision"]) == (10, 0, "proceed")


def _three_loads(spark, incremental, insert_new):
    lake = Lake(spark, LakeConfig(scratch_dir(spark, "lake_f")))
    ev = order_events(spark, SF_SMALL)
    ts = F.col("event_ts")
    cuts = [dt.datetime(1997, 1, 1), dt.datetime(1998, 7, 1)]
    loads = [ev.where(ts < F.lit(cuts[0]).cast("timestamp_ntz")),
             ev.where((ts >= F.lit(cuts[0]).cast("timestamp_ntz"))
                      & (ts < F.lit(cuts[1]).cast("timestamp_ntz"))),
             ev.where(ts >= F.lit(cuts[1]).cast("timestamp_ntz"))]
    for load in loads:
        lake.append_bronze(load)
        lake.run_all(insert_new=insert_new, incremental=incremental)
    return lake


def test_incremental_fact_equals_full_rebuild(spark):
    from starmart.sources import tables
    for insert_new in (False, True):
        inc = _three_loads(spark, True, insert_new)
        full = _three_loads(spark, False, insert_new)
        ops = [r.operation for r in tables.load_audit(spark, inc.cfg.fact_orders, 3).collect()]
        assert ops == ["MERGE", "MERGE", "WRITE"]
        for path in ("fact_orders", "dim_customer"):
            a = sorted(map(tuple, inc.table(getattr(inc.cfg, path)).collect()), key=str)
            b = sorted(map(tuple, full.table(getattr(full.cfg, path)).collect()), key=str)
            assert a == b, (path, insert_new)


def test_run_stage_rejects_unknown(spark):
    import pytest
    lake = Lake(spark, LakeConfig(scratch_dir(spark, "lake_u")))
    with pytest.raises(ValueError, match="no stage named"):
        lake.run_stage("gold")


def test_cli_stream_stage_bounded_run(spark):
    from starmart.plans.runner import main
    from starmart.sources import bronze as bronze_io
    root = scratch_dir(spark, "lake_s")
    cfg = LakeConfig(root)
    ev = order_events(spark, SF_SMALL)
    bronze_io.write_ndjson(ev, cfg.raw)
    assert main(["--lake", root, "--stage", "stream", "--seconds", "12"]) == 0
    assert not spark.streams.active
    assert Lake(spark, cfg).bronze().count() == ev.count()


def test_rerun_without_new_data_changes_nothing(spark):
    lake = Lake(spark, LakeConfig(scratch_dir(spark, "lake_r")))
    lake.append_bronze(order_events(spark, SF_SMALL))
    lake.run_all()

    def state():
        return [sorted(map(tuple, lake.table(p).collect()), key=str)
                for p in (lake.cfg.dim_customer, lake.cfg.fact_orders)] + [
            sorted(map(tuple, lake.silver().collect()), key=str)]
    before = state()
    lake.run_all(incremental=True)          # merge paths with nothing new
    assert state() == before
    from starmart.sources import tables
    assert tables.last_record(spark, lake.cfg.dim_customer)["operation"] == "MERGE"
    assert tables.read(spark, lake.cfg.dim_customer_changes).count() == 0
