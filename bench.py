"""Benchmark: the two-load star-schema build and the serving queries.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints ONE JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Timed parts
* pipeline stages over three loads (events before 1998; up to March 2001;
  the last five months as a small increment): bronze append, gate, silver,
  dim_customer (init, then SCD2 merges), dim_product, dim_date, fact, marts
  – each writes its snapshot, as in production; the small last load takes
  the incremental silver and fact paths;
* serving queries over the published gold tables (full execution through
  the no-op sink, all columns);
* stream ingest: all events as NDJSON files through the file source
  (``availableNow``) into a checkpointed bronze sink;
* end-to-end registered queries from the raw tables (one plan each).

Spark's event log is written to a scratch folder; per timed item the JSON
also reports jobs, tasks, task time, bytes read and shuffle bytes written
(``"metrics"``).
"""

from __future__ import annotations

import datetime as dt
import glob
import json
import os
import re
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def event_log_metrics(log_dir: str) -> dict:
    """Per job description: jobs, tasks, task time (s), input and shuffle-write MB."""
    job_desc, stage_job, out = {}, {}, defaultdict(lambda: defaultdict(float))
    paths = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(p))
    for path in paths:
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    if desc:
                        job_desc[ev["Job ID"]] = desc
                        out[desc]["jobs"] += 1
                        for sid in ev.get("Stage IDs", []):
                            stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    desc = job_desc.get(stage_job.get(ev.get("Stage ID")))
                    m = ev.get("Task Metrics") or {}
                    if not desc or not m:
                        continue
                    o = out[desc]
                    o["tasks"] += 1
                    o["task_sec"] += m.get("Executor Run Time", 0) / 1000.0
                    o["input_mb"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0) / 2**20
                    o["shuffle_write_mb"] += (m.get("Shuffle Write Metrics") or {}).get(
                        "Shuffle Bytes Written", 0) / 2**20
    return {k: {kk: round(vv, 2) for kk, vv in v.items()} for k, v in out.items()}


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    from pyspark.sql import functions as F

    from starmart.operators.history import scd2_full_history
    from starmart.operators.scd2 import dim_as_of
    from starmart.plans import marts
    from starmart.plans.catalog import registered
    from starmart.plans.runner import Lake, LakeConfig
    from starmart.session import build_session, scratch_dir
    from starmart.sources.fixtures import order_events

    log_dir = tempfile.mkdtemp(prefix="starmart-eventlog-")
    # driver heap: 16 GB, or 60 % of the machine's memory when that is less
    try:
        ram_gb = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") / 2**30
    except (ValueError, OSError, AttributeError):
        ram_gb = 32
    heap = f"{max(1, min(16, int(ram_gb * 0.6)))}g"
    spark = build_session(f"local[{cpus}]", app_name="starmart-bench",
                          shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": heap,
                                 "spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false"})
    timings: dict[str, float] = {}

    errors: dict[str, str] = {}

    def run(name, fn):
        spark.sparkContext.setJobDescription(name)
        t = time.time()
        try:
            fn()
            timings[name] = round(time.time() - t, 3)
        except Exception as e:  # keep measuring the rest; report the failure
            errors[name] = repr(e)[:300]
        finally:
            spark.sparkContext.setJobDescription(None)

    def sink(df):
        df.write.format("noop").mode("overwrite").save()

    # warm-up: JVM, file listing
    order_events(spark, sf_dir).select("event_id").write.format("noop").mode("overwrite").save()

    lake = Lake(spark, LakeConfig(scratch_dir(spark, "bench_lake")))
    ev = order_events(spark, sf_dir)
    ts = F.col("event_ts")
    cuts = [F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz"),
            F.lit(dt.datetime(2001, 3, 1)).cast("timestamp_ntz")]
    # history, a large second load (full rebuilds), a small daily-style
    # increment (incremental silver + fact)
    loads = [ev.where(ts < cuts[0]), ev.where((ts >= cuts[0]) & (ts < cuts[1])),
             ev.where(ts >= cuts[1])]
    t0 = time.time()
    stage_load = []
    for n, load in enumerate(loads, 1):
        lake.job_prefix = f"load{n}_"
        before = len(lake.log)
        lake.append_bronze(load)
        top = lake.run_all()
        stage_load += [n] * (len(lake.log) - before)
    timings["pipeline_total"] = round(time.time() - t0, 3)
    rows = {}
    for n, e in zip(stage_load, lake.log):
        timings[f"load{n}_{e['stage']}"] = e["sec"]
        if e.get("rows") is not None:
            rows[f"load{n}_{e['stage']}"] = e["rows"]
    from starmart.sources import tables
    ops = {name: [r.operation for r in tables.load_audit(spark, path, 3).collect()][::-1]
           for name, path in (("silver", lake.cfg.silver), ("fact", lake.cfg.fact_orders))}

    fact = lake.table(lake.cfg.fact_orders)
    dc = lake.table(lake.cfg.dim_customer)
    dp = lake.table(lake.cfg.dim_product)
    silver = lake.silver()
    run("gold_revenue_top10", lambda: top.collect())
    run("gold_sales_summary", lambda: sink(marts.sales_summary(fact, dc, dp)))
    run("gold_sales_summary_by_region",
        lambda: sink(marts.sales_summary_by_region(fact, dc, dp, "EUROPE")))
    run("gold_customer_ltv", lambda: marts.customer_ltv(fact, dc, "C7").collect())
    run("gold_customer_ltv_all", lambda: sink(marts.customer_ltv_all(fact, dc)))
    run("gold_revenue_as_was", lambda: sink(marts.revenue_as_was(fact, dc, dp)))
    run("silver_full_history", lambda: sink(scd2_full_history(silver)))
    run("silver_dim_as_of",
        lambda: sink(dim_as_of(scd2_full_history(silver), dt.date(1998, 12, 31))))

    # bronze file sink with checkpoint; the drop itself is setup, not timed
    from starmart.sources import bronze as bronze_io
    from starmart.streaming.bronze_stream import file_source, start_bronze_stream
    raw = scratch_dir(spark, "bench_raw")
    bronze_io.write_ndjson(ev, raw)
    out, ckpt = scratch_dir(spark, "bench_stream"), scratch_dir(spark, "bench_stream_ckpt")

    def stream_all():
        start_bronze_stream(file_source(spark, raw), out, ckpt, available_now=True).awaitTermination()
    run("stream_ingest", stream_all)
    streamed = spark.read.parquet(out).count() if "stream_ingest" in timings else 0

    q = registered()
    for name in ("silver_orders", "scd2_apply", "fact_orders", "revenue_top10",
                 "customer_ltv_all", "quality_gate", "dim_date"):
        run(f"e2e_{name}", lambda n=name: sink(q[n](spark, sf_dir)))

    total = round(sum(v for k, v in timings.items() if k != "pipeline_total"
                      and not re.match(r"load\d_", k)) + timings["pipeline_total"], 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    silver_rows = rows.get("load3_silver")
    stage_rps = {k: round(rows[k] / timings[k], 1) for k in rows if timings.get(k)}
    out = {"metric": "starmart_total_sec", "value": total, "unit": "sec",
           "flagship_sec": timings.get("gold_revenue_top10"),
           "stream_ingest_rows_per_sec": (round(streamed / timings["stream_ingest"], 1)
                                          if timings.get("stream_ingest") else None),
           "stage_rows_per_sec": stage_rps,
           "queries": timings, "sf": float(sf.group(1)) if sf else sf_dir,
           "cpus": cpus, "rows": rows, "operations": ops,
           "pipeline_rows_per_sec": round(silver_rows / timings["pipeline_total"], 1)
           if silver_rows else None}
    if errors:
        out["errors"] = errors
    spark.stop()
    try:
        out["metrics"] = event_log_metrics(log_dir)
    except Exception as e:  # the timings stand on their own
        out["metrics_error"] = repr(e)[:200]
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
