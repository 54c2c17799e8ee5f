"""Stage runner: bronze -> quality gate -> silver -> {dimensions} -> fact ->
marts, each stage reading the previous stage's published snapshot.

Every stage's output is a written table in the lake (a lineage cut): a
later stage, or a retry after a lost executor, starts from committed files
instead of recomputing the chain.  Stage order is a plain call order (no
scheduler).  CLI::

    python -m starmart.plans.runner --lake /shared/lake --stage all
    python -m starmart.plans.runner --lake /shared/lake --stage ingest
    python -m starmart.plans.runner --lake /shared/lake --stage stream --seconds 60
"""

from __future__ import annotations

import argparse
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.exprs import event_date
from starmart.functions.schemas import CONTRACTS, GATE_THRESHOLD, check_contract
from starmart.operators.dims import dim_date, dim_product
from starmart.operators.facts import by_status_day, changed_keys, fact_orders, fact_orders_incremental
from starmart.operators.quality import PROCEED, QUARANTINE, quality_gate
from starmart.operators.scd2 import (customer_latest, scd2_apply, scd2_changes, scd2_init,
                                     scd2_newcomers)
from starmart.operators.skew import DEFAULT_MIN_SHARE
from starmart.plans import marts
from starmart.plans.silver import VALID, checked, files_of, incremental_checked, read_files, unread
from starmart.session import shared_root
from starmart.sources import bronze as bronze_io
from starmart.sources import buckets, tables
from starmart.sources.buckets import cut

# Merge an increment into silver only while it is small next to the history.
INCREMENTAL_MAX_SHARE = 0.25

LTV = T.StructType([T.StructField("customer_id", T.StringType()), T.StructField("ltv", T.DoubleType())])
LTV_BUCKETS = 32   # folders of the published lifetime values; a look-up reads one

STAGES = ("ingest", "stream", "gate", "silver", "dim_customer", "dim_product", "dim_date",
          "fact", "marts", "sales_summary", "customer_ltv", "revenue_by_week", "all")


@dataclass(frozen=True)
class LakeConfig:
    """Lake root and the layer paths below it; ``fact_days`` publishes the fact
    by status and day instead of status only."""

    root: str
    fact_days: bool = False

    @classmethod
    def for_session(cls, spark: SparkSession, root: str | None = None, fact_days: bool = False) -> "LakeConfig":
        return cls(root or shared_root(spark) + "/lake", fact_days)

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def raw(self) -> str: return self._p("raw_stream")
    @property
    def bronze(self) -> str: return self._p("bronze", "orders")
    @property
    def bronze_stream(self) -> str: return self._p("bronze", "orders_stream")
    @property
    def checkpoint(self) -> str: return self._p("_checkpoints", "bronze_orders")
    @property
    def silver(self) -> str: return self._p("silver", "orders_checked")
    @property
    def silver_touched(self) -> str: return self._p("silver", "orders_touched")
    @property
    def silver_inputs(self) -> str: return self._p("silver", "orders_inputs")
    @property
    def dim_customer_changes(self) -> str: return self._p("gold", "dim_customer_changes")
    @property
    def dim_customer(self) -> str: return self._p("gold", "dim_customer")
    @property
    def dim_product(self) -> str: return self._p("gold", "dim_product")
    @property
    def dim_date(self) -> str: return self._p("gold", "dim_date")
    @property
    def fact_orders(self) -> str: return self._p("gold", "fact_orders")
    @property
    def sales_summary(self) -> str: return self._p("gold", "sales_summary")
    @property
    def customer_ltv(self) -> str: return self._p("gold", "customer_ltv")


class Lake:
    """Stage functions over one lake."""

    def __init__(self, spark: SparkSession, cfg: LakeConfig,
                 hot_share: float | None = DEFAULT_MIN_SHARE):
        self.spark, self.cfg = spark, cfg
        self.hot_share = hot_share
        self.job_prefix = "starmart:"
        self.log: list[dict] = []

    # -- reads -------------------------------------------------------------
    def bronze(self) -> DataFrame:
        return bronze_io.read_bronze(self.spark, self.cfg.bronze, self.cfg.bronze_stream)

    def silver(self, version: int | None = None) -> DataFrame:
        """Valid rows of the checked table (a partition filter)."""
        return (tables.read(self.spark, self.cfg.silver, version)
                .where(F.col("quality") == VALID).drop("quality"))

    def quarantine(self) -> DataFrame:
        return (tables.read(self.spark, self.cfg.silver)
                .where(F.col("quality") != VALID).withColumnRenamed("quality", "reject_reason"))

    def table(self, path: str) -> DataFrame:
        return tables.read(self.spark, path)

    # -- stages ------------------------------------------------------------
    def _timed(self, stage: str, fn):
        # label the stage's Spark jobs (event log, monitoring)
        self.spark.sparkContext.setJobDescription(f"{self.job_prefix}{stage}")
        t = time.time()
        try:
            rec = fn()
        finally:
            self.spark.sparkContext.setJobDescription(None)
        entry = {"stage": stage, "sec": round(time.time() - t, 3)}
        if isinstance(rec, dict):
            entry.update({k: v for k, v in rec.items() if k in ("rows", "version", "decision")})
        self.log.append(entry)
        return rec

    def ingest(self, raw_dir: str | None = None) -> dict:
        return self._timed("ingest", lambda: bronze_io.ingest_batch(
            self.spark, raw_dir or self.cfg.raw, self.cfg.bronze))

    def append_bronze(self, events: DataFrame) -> dict:
        """Append already-typed bronze rows (e.g. a replayed feed)."""
        return self._timed("ingest", lambda: tables.append(
            events, self.cfg.bronze, partition_by=[bronze_io.BRONZE_PARTITION]))

    def stream(self, seconds: float = 60, kafka_servers: str | None = None,
               available_now: bool = False, max_files: int | None = None,
               starting_offsets: str | None = None, max_offsets: int | None = None,
               trigger_interval: str | None = None):
        """Stream into bronze; limits left out are those of bronze_stream.py."""
        from starmart.streaming import bronze_stream as b
        src = (b.kafka_source(self.spark, kafka_servers,
                              starting_offsets=starting_offsets or b.STARTING_OFFSETS,
                              max_offsets_per_trigger=max_offsets or b.MAX_OFFSETS_PER_TRIGGER)
               if kafka_servers else b.file_source(self.spark, self.cfg.raw, max_files))
        q = b.start_bronze_stream(src, self.cfg.bronze_stream, self.cfg.checkpoint,
                                  trigger_interval=trigger_interval or b.TRIGGER_INTERVAL,
                                  available_now=available_now)
        if available_now:
            q.awaitTermination()
        else:
            b.run_for(q, seconds)
        return q

    def gate(self, threshold: float = GATE_THRESHOLD, increment_only: bool = False) -> dict:
        """Quality metrics and decision over all of bronze (the reference's
        rule) or, with ``increment_only``, over the files that no silver build
        has read – exactly those the next incremental build reads."""
        def run():
            consumed = self._consumed() if increment_only else None
            if consumed is None:
                return quality_gate(self.bronze(), (threshold,)).first().asDict()
            files = unread(files_of(self.spark, self._roots()), consumed)
            if not files:  # nothing arrived since the last build: nothing to hold back
                return {"threshold": threshold, "total": 0, "nulls": 0, "bad_totals": 0, "null_rate": 0.0, "decision": PROCEED}
            scope = bronze_io.union_all(self.spark, read_files(self.spark, files))
            return quality_gate(scope, (threshold,)).first().asDict()
        return self._timed("gate", run)

    def _roots(self) -> list[str]:
        """The bronze folders that are there."""
        return [p for p in (self.cfg.bronze, self.cfg.bronze_stream) if tables.path_exists(self.spark, p)]

    def _consumed(self) -> DataFrame | None:
        """(root, path) of the bronze files that the last silver build had read."""
        return (tables.read(self.spark, self.cfg.silver_inputs)
                if tables.exists(self.spark, self.cfg.silver_inputs) else None)

    def build_silver(self, incremental: bool | None = None) -> dict:
        """Dedup, tag each row valid / first failing rule, write one table
        partitioned by that tag: silver and quarantine are partition reads.

        Incremental: only bronze files that no build has read (their paths are
        recorded with each build) are read, and only the events they touch are re-evaluated against the
        previous winners – no shuffle of the whole history.  Same result as
        a full rebuild (tested).  ``incremental=None`` chooses by size: the
        increment's row count (from file footers) against the previous
        table's (from its audit record); below ``INCREMENTAL_MAX_SHARE`` the
        increment is merged, otherwise silver is rebuilt."""
        def run():
            last = (tables.load_audit(self.spark, self.cfg.silver, 1).collect()
                    if tables.exists(self.spark, self.cfg.silver) else [])
            # listed before the build: a file committed later stays unread
            files = cut(files_of(self.spark, self._roots()), "silver-files")
            consumed = self._consumed() if last and incremental is not False else None
            fresh = (bronze_io.union_all(self.spark, read_files(self.spark, unread(files, consumed)))
                     if consumed is not None else None)
            merge = fresh is not None and (
                incremental is True or fresh.count() < INCREMENTAL_MAX_SHARE * (last[0]["rows"] or 0))
            if merge:
                prev = tables.read(self.spark, self.cfg.silver)
                out, op = incremental_checked(prev, fresh), "MERGE"
            else:
                out, op = checked(self.bronze()), "WRITE"
            rec = tables.publish(out, self.cfg.silver, op, partition_by=["quality"])
            # after silver: a crash between the two only reads files again,
            # which changes no winner
            tables.publish(files, self.cfg.silver_inputs, "WRITE", sources={"silver": rec["version"]})
            if merge:
                # the ids this merge re-evaluated, for the incremental fact
                tables.publish(fresh.select("event_id").distinct(), self.cfg.silver_touched,
                               "WRITE", sources={"silver": rec["version"]})
            return rec
        return self._timed("silver", run)

    def build_dim_product(self) -> dict:
        return self._timed("dim_product", lambda: tables.publish(
            check_contract(dim_product(self.silver()), CONTRACTS["dim_product"]),
            self.cfg.dim_product, "WRITE"))

    def build_dim_date(self) -> dict:
        # laid out by year (the table-format alternative partitions by years(full_date))
        return self._timed("dim_date", lambda: tables.publish(
            check_contract(dim_date(self.silver()), CONTRACTS["dim_date"]),
            self.cfg.dim_date, "WRITE", partition_by=["year"]))

    def build_dim_customer(self, insert_new: bool = False, null_safe: bool = False) -> dict:
        """First run: initial load.  Later runs: detect changes against the
        current snapshot, close + insert in one plan, publish as the next
        snapshot (the one being read is never modified)."""
        def run():
            latest = customer_latest(self.silver())
            if not tables.exists(self.spark, self.cfg.dim_customer):
                return tables.publish(check_contract(scd2_init(latest), CONTRACTS["dim_customer"]),
                                      self.cfg.dim_customer, "WRITE")
            base = tables.versions(self.spark, self.cfg.dim_customer)[-1]
            cur = tables.read(self.spark, self.cfg.dim_customer, version=base)
            # the change set (changed + newly inserted customers) is published
            # first: the merge reads it back, and the incremental fact uses it
            # to find the customers whose versions moved
            side = scd2_changes(latest, cur, null_safe=null_safe).withColumn("kind", F.lit("change"))
            if insert_new:
                side = side.unionByName(
                    scd2_newcomers(latest, cur).withColumn("kind", F.lit("new")))
            side_rec = tables.publish(side, self.cfg.dim_customer_changes, "WRITE",
                                      sources={"base": base})
            if side_rec["rows"] == 0:  # nothing to close or insert: the snapshot stands
                return tables.record_unchanged(self.spark, self.cfg.dim_customer, "MERGE",
                                               {"base": base, "changes": side_rec["version"]})
            side = tables.read(self.spark, self.cfg.dim_customer_changes)
            out = scd2_apply(cur, side.where(F.col("kind") == "change").drop("kind"), latest,
                             insert_new=insert_new,
                             newcomers=side.where(F.col("kind") == "new").drop("kind"))
            return tables.publish(check_contract(out, CONTRACTS["dim_customer"]),
                                  self.cfg.dim_customer, "MERGE",
                                  sources={"base": base, "changes": side_rec["version"]})
        return self._timed("dim_customer", run)

    def build_fact(self, incremental: bool | None = None) -> dict:
        """Fact from silver and the current dimensions.

        Incremental when the previous fact was built from the silver
        snapshot this silver merge started from: only events the merge
        touched and events of customers whose dimension rows changed are
        rebuilt (exact, tested against the full build).  ``None`` also
        requires the touched ids to be under ``INCREMENTAL_MAX_SHARE`` of
        the fact; otherwise (or after a full silver rebuild) the fact is
        rebuilt."""
        def run():
            silver_rec = tables.last_record(self.spark, self.cfg.silver)
            sources = {"silver": silver_rec["version"],
                       "dim_customer": tables.versions(self.spark, self.cfg.dim_customer)[-1]}
            # the recorded snapshots, not newer ones whose record is not written yet
            silver = self.silver(sources["silver"])
            dc = tables.read(self.spark, self.cfg.dim_customer, sources["dim_customer"])
            dp = self.table(self.cfg.dim_product)
            fact_rec = (tables.last_record(self.spark, self.cfg.fact_orders)
                        if tables.exists(self.spark, self.cfg.fact_orders) else None)
            touched_rec = (tables.last_record(self.spark, self.cfg.silver_touched)
                           if tables.exists(self.spark, self.cfg.silver_touched) else None)
            inc = (incremental is not False and fact_rec is not None
                   and silver_rec["operation"] == "MERGE"
                   and fact_rec["sources"].get("silver") == silver_rec["version"] - 1
                   and touched_rec is not None
                   and touched_rec["sources"].get("silver") == silver_rec["version"]
                   and (incremental is True
                        or touched_rec["rows"] < INCREMENTAL_MAX_SHARE * fact_rec["rows"]))
            if inc:
                fact = fact_orders_incremental(
                    self.table(self.cfg.fact_orders), silver, dc, dp,
                    self.table(self.cfg.silver_touched),
                    self._changed_customers(fact_rec["sources"]["dim_customer"]),
                    hot_share=self.hot_share)
                op = "MERGE"
            else:
                fact, op = fact_orders(silver, dc, dp, hot_share=self.hot_share), "WRITE"
            fact, layout = check_contract(fact, CONTRACTS["fact_orders"]), ["status"]
            if self.cfg.fact_days:
                n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
                fact, layout = by_status_day(fact, n), ["status", "event_day"]
            return tables.publish(fact, self.cfg.fact_orders, op, partition_by=layout, sources=sources)
        return self._timed("fact", run)

    def _changed_customers(self, since_version: int) -> DataFrame:
        """Customers whose dimension rows differ from version ``since_version``:
        the change set the SCD2 merge published when the dimension's newest
        version was built directly on ``since_version``; otherwise a diff of
        the two snapshots."""
        rec = tables.last_record(self.spark, self.cfg.dim_customer)
        if rec and rec["version"] == since_version:
            return self.table(self.cfg.dim_customer).select("customer_id").where(F.lit(False))
        if (rec and rec["operation"] == "MERGE" and rec["sources"].get("base") == since_version
                and "changes" in rec["sources"]):
            return tables.read(self.spark, self.cfg.dim_customer_changes,
                               version=rec["sources"]["changes"]).select("customer_id").distinct()
        prev = tables.read(self.spark, self.cfg.dim_customer, version=since_version)
        return changed_keys(self.table(self.cfg.dim_customer), prev, "customer_id")

    def marts(self) -> tuple[dict, DataFrame]:
        """Publish the sales summary (materialized serving result, partitioned
        by region) and return the top-10 revenue frame."""
        fact, dc, dp = (self.table(self.cfg.fact_orders), self.table(self.cfg.dim_customer),
                        self.table(self.cfg.dim_product))
        rec = self._timed("marts", lambda: tables.publish(
            marts.sales_summary(fact, dc, dp), self.cfg.sales_summary, "WRITE",
            partition_by=["customer_region"]))
        self._timed("customer_ltv", lambda: self._publish_ltv(fact, dc))
        return rec, marts.revenue_top10_sql(fact, dc, dp)

    def sales_summary(self, region: str | None = None) -> DataFrame:
        """The published summary, of one region (a partition filter) or all."""
        df = self.table(self.cfg.sales_summary)
        if region is not None:
            df = df.where(F.col("customer_region") == region)
        return df.orderBy(F.col("revenue").desc(), "customer_region", "product_category")

    def revenue_by_week(self, year: int) -> DataFrame:
        """Weekly revenue of one year from the published fact and calendar; of a
        fact published by day only the year's folders are read."""
        fact = self.table(self.cfg.fact_orders)
        if "event_day" not in fact.columns:
            fact = fact.withColumn("event_day", event_date())
        return marts.revenue_by_week(fact, self.table(self.cfg.dim_date), year).orderBy("week_of_year")

    def customer_ltv(self, customer_id: str) -> DataFrame:
        """Lifetime value of one customer (0 when unknown) from the published
        values: one bucket is read."""
        spark = self.spark
        one = spark.createDataFrame([(customer_id,)], "customer_id string")
        bucket = one.select(buckets.bucket_of(["customer_id"], LTV_BUCKETS)).first()[0]
        found = buckets.read(spark, tables.version_path(self.cfg.customer_ltv, tables.versions(spark, self.cfg.customer_ltv)[-1]), LTV, [bucket])
        found = found.where(F.col("customer_id") == customer_id)
        return one.join(found.select("customer_id", "ltv"), "customer_id", "left").select("customer_id", F.coalesce("ltv", F.lit(0.0)).alias("ltv"))

    def _publish_ltv(self, fact: DataFrame, dim_customer: DataFrame) -> dict:
        """Lifetime value of every customer, in buckets of the customer id."""
        ltv = marts.customer_ltv_all(fact, dim_customer).withColumn(buckets.BUCKET, buckets.bucket_of(["customer_id"], LTV_BUCKETS))
        return tables.publish(ltv.repartition(buckets.BUCKET), self.cfg.customer_ltv, "WRITE", partition_by=[buckets.BUCKET])

    def register_views(self) -> None:
        """Temp views ``fact_orders``, ``dim_customer``, ``dim_product``,
        ``dim_date`` over the newest snapshots, for ad-hoc SQL."""
        marts.register_views(self.table(self.cfg.fact_orders), self.table(self.cfg.dim_customer),
                             self.table(self.cfg.dim_product), self.table(self.cfg.dim_date))

    def run_all(self, threshold: float = GATE_THRESHOLD, insert_new: bool = False,
                incremental: bool | None = None,
                gate_increment_only: bool = False) -> DataFrame | None:
        """gate -> silver -> dimensions -> fact -> marts.  Returns the top-10
        revenue frame, or None when the gate quarantines the load."""
        if self.gate(threshold, increment_only=gate_increment_only)["decision"] == QUARANTINE:
            return None
        self.build_silver(incremental=incremental)
        self.build_dim_customer(insert_new=insert_new)
        self.build_dim_product()
        self.build_dim_date()
        self.build_fact(incremental=incremental)
        return self.marts()[1]

    def run_stage(self, stage: str, **kw):
        fns = {"ingest": self.ingest, "stream": self.stream, "gate": self.gate,
               "silver": self.build_silver, "dim_customer": self.build_dim_customer,
               "dim_product": self.build_dim_product, "dim_date": self.build_dim_date,
               "fact": self.build_fact, "marts": self.marts, "all": self.run_all,
               "sales_summary": self.sales_summary, "customer_ltv": self.customer_ltv,
               "revenue_by_week": self.revenue_by_week}
        if stage not in fns:
            raise ValueError(f"no stage named {stage!r}; there are {', '.join(sorted(fns))}")
        return fns[stage](**kw)


def main(argv: list[str] | None = None) -> int:
    from starmart.session import build_session
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--lake", default=None, help="lake root (default: under spark.checkpoint.dir)")
    ap.add_argument("--stage", choices=STAGES, default="all")
    ap.add_argument("--master", default=None)
    ap.add_argument("--seconds", type=float, default=60.0, help="stream run length")
    ap.add_argument("--kafka", default=None, help="bootstrap servers (stream stage)")
    ap.add_argument("--available-now", action="store_true", help="stream what is there, then stop")
    ap.add_argument("--max-files", type=int, default=None, help="files per micro-batch of the file stream")
    ap.add_argument("--starting-offsets", default=None, help="start position of the Kafka stream")
    ap.add_argument("--max-offsets", type=int, default=None, help="offsets per micro-batch of the Kafka stream")
    ap.add_argument("--trigger", default=None, help="interval between micro-batches, such as '10 seconds'")
    ap.add_argument("--region", default=None, help="region of the sales_summary stage (default: all)")
    ap.add_argument("--customer", default=None, help="customer id of the customer_ltv stage")
    ap.add_argument("--year", type=int, default=None, help="year of the revenue_by_week stage")
    ap.add_argument("--fact-days", action="store_true", help="publish the fact by status and day")
    ap.add_argument("--threshold", type=float, default=GATE_THRESHOLD)
    ap.add_argument("--insert-new", action="store_true")
    ap.add_argument("--full-silver", action="store_true", help="rebuild silver from all bronze")
    ap.add_argument("--gate-increment-only", action="store_true",
                    help="measure the quality gate on the newly committed bronze files only")
    ap.add_argument("--shuffle-partitions", type=int, default=None,
                    help="initial shuffle partitions (AQE coalesces them by measured size)")
    a = ap.parse_args(argv)
    spark = build_session(a.master, shuffle_partitions=a.shuffle_partitions)
    lake = Lake(spark, LakeConfig.for_session(spark, a.lake, a.fact_days))
    if a.stage == "all":
        top = lake.run_all(a.threshold, a.insert_new, incremental=False if a.full_silver else None,
                           gate_increment_only=a.gate_increment_only)
        if top is None:
            print("quality gate: quarantine")
            return 1
        top.show(truncate=False)
    elif a.stage == "stream":
        lake.stream(a.seconds, a.kafka, available_now=a.available_now, max_files=a.max_files,
                    starting_offsets=a.starting_offsets, max_offsets=a.max_offsets, trigger_interval=a.trigger)
    elif a.stage == "sales_summary":
        lake.sales_summary(a.region).show(truncate=False)
    elif a.stage == "customer_ltv":
        if a.customer is None:
            ap.error("customer_ltv needs --customer")
        lake.customer_ltv(a.customer).show(truncate=False)
    elif a.stage == "revenue_by_week":
        if a.year is None:
            ap.error("revenue_by_week needs --year")
        lake.revenue_by_week(a.year).show(60, truncate=False)
    elif a.stage == "gate":
        print(lake.gate(a.threshold, increment_only=a.gate_increment_only))
    elif a.stage == "silver":
        lake.build_silver(incremental=False if a.full_silver else None)
    elif a.stage == "dim_customer":
        lake.build_dim_customer(insert_new=a.insert_new)
    else:
        lake.run_stage(a.stage)
    for e in lake.log:
        print(e)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
