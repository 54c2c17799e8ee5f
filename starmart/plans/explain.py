"""Print the physical plans of the main stages (for review).

    python -m starmart.plans.explain /root/testdata/sf0.01 > docs/PLANS.md

Builds a small lake with the runner (three loads, the last a small
increment), then shows, for each stage
read from its published inputs: the plan tree and the scan lines
(ReadSchema / PushedFilters / PartitionFilters).  "large" variants disable
every broadcast to show the plan a cluster-sized dimension gets."""

from __future__ import annotations

import datetime as dt
import re
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _tree(spark, df: DataFrame) -> str:
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    lines = text.splitlines()
    tree = []
    for line in lines[1:]:
        if not line.strip():
            break
        tree.append(re.sub(r" \(\d+\)$", "", line))
    scans = [ln.strip() if len(ln.strip()) <= 160 else ln.strip()[:157] + "..."
             for ln in lines
             if ln.strip().startswith(("ReadSchema:", "PushedFilters:", "PartitionFilters:"))]
    return "\n".join(tree + [""] + scans)


def _scd2_merge(lake) -> DataFrame:
    from starmart.operators.scd2 import customer_latest, scd2_apply, scd2_changes
    cur = lake.table(lake.cfg.dim_customer)
    latest = customer_latest(lake.silver())
    return scd2_apply(cur, scd2_changes(latest, cur), latest)


def main(argv: list[str]) -> int:
    from starmart.operators.facts import changed_keys, fact_orders, fact_orders_incremental
    from starmart.operators.history import scd2_full_history
    from starmart.plans import marts
    from starmart.plans.runner import Lake, LakeConfig
    from starmart.plans.silver import checked, files_of, incremental_checked, read_files, unread
    from starmart.session import build_session, scratch_dir
    from starmart.sources import bronze as bronze_io
    from starmart.sources import tables
    from starmart.sources.fixtures import order_events

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    lake = Lake(spark, LakeConfig(scratch_dir(spark, "explain_lake")), hot_share=None)
    ev = order_events(spark, sf_dir)
    first = F.col("event_ts") < F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz")
    last = F.col("event_ts") >= F.lit(dt.datetime(2001, 3, 1)).cast("timestamp_ntz")
    lake.append_bronze(ev.where(first))
    lake.run_all()
    lake.append_bronze(ev.where(~first & ~last))
    lake.run_all()
    prev_fact_version = tables.versions(spark, lake.cfg.fact_orders)[-1]
    prev_dc_version = tables.versions(spark, lake.cfg.dim_customer)[-1]
    lake.append_bronze(ev.where(last))       # a small increment: merge paths
    lake.build_silver()
    lake.build_dim_customer()
    lake.build_dim_product()
    silver = lake.silver()
    fact, dc, dp = (lake.table(lake.cfg.fact_orders), lake.table(lake.cfg.dim_customer),
                    lake.table(lake.cfg.dim_product))
    parts = bronze_io.bronze_parts(spark, lake.cfg.bronze)
    files = files_of(spark, [lake.cfg.bronze])
    consumed = tables.read(spark, lake.cfg.silver_inputs)
    # the increment of the plan: what the last build read and no earlier one had
    earlier = tables.read(spark, lake.cfg.silver_inputs, version=tables.versions(spark, lake.cfg.silver_inputs)[-2])
    fresh = read_files(spark, unread(files, earlier))[0]

    sections = [
        ("silver: dedup + quality tag (full build)",
         lambda: checked(bronze_io.union_all(spark, parts))),
        ("silver: incremental merge of files that no build has read",
         lambda: incremental_checked(tables.read(spark, lake.cfg.silver),
                                     fresh)),
        ("silver: bronze files that no build has read (a listing, no file is opened)",
         lambda: files.join(consumed, ["root", "path"], "left_anti")),
        ("fact: dimensions proven small (broadcast)",
         lambda: fact_orders(silver, dc, dp)),
        ("marts: sales summary, dimensions proven small",
         lambda: marts.sales_summary(fact, dc, dp)),
        ("dim_customer: SCD2 merge (change set broadcast after a row-count check)",
         lambda: _scd2_merge(lake)),
        ("full SCD2 history (segmented neighbour lookup)",
         lambda: scd2_full_history(silver)),
        ("fact: incremental rebuild after a small silver merge",
         lambda: fact_orders_incremental(
             tables.read(spark, lake.cfg.fact_orders, version=prev_fact_version),
             lake.silver(), lake.table(lake.cfg.dim_customer), lake.table(lake.cfg.dim_product),
             lake.table(lake.cfg.silver_touched),
             changed_keys(lake.table(lake.cfg.dim_customer),
                          tables.read(spark, lake.cfg.dim_customer, version=prev_dc_version),
                          "customer_id"))),
    ]
    large = [("fact: large dimensions, hot keys split off (threshold lowered so the "
               "busiest customers count as hot)",
              lambda: fact_orders(silver, dc, dp, hot_share=0.0015, max_broadcast_rows=0)),
             ("marts: sales summary, large dimensions (aggregation below both joins)",
              lambda: marts.sales_summary(fact, dc, dp))]
    print(f"# Physical plans ({sf_dir}, local[8], AQE initial plans)\n")
    print("At this scale Catalyst broadcasts small sides on its own; the last "
          "sections switch every broadcast off to show the plans cluster-sized "
          "dimensions get.\n")
    print("Generated by `python -m starmart.plans.explain`.\n")
    for title, make in sections:
        print(f"## {title}\n\n```\n{_tree(spark, make())}\n```\n")
    old = marts.MAX_BROADCAST_DIM_ROWS
    marts.MAX_BROADCAST_DIM_ROWS = 0
    for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(k, "-1")
    try:
        for title, make in large:
            print(f"## {title}\n\n```\n{_tree(spark, make())}\n```\n")
    finally:
        marts.MAX_BROADCAST_DIM_ROWS = old
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
